"""Byte-level BPE encoding and decoding (operator 11).

A text is cut at added tokens, then by the pre-tokenizer's pattern into words.
A short word is held as a contiguous array of parts (the ids between its
boundaries) beside the array of the ranks of adjacent parts: the least rank is
found by a scan, the boundary under it is deleted, and the ranks of its two
neighbours are looked up again.  A scan costs the word's length, so a word
above ``SHORT`` bytes keeps its boundaries in a linked list and its ranks in a
heap; both give the same ids.

Merges are looked up by the two parts' ids, as the tokenizer's own list names
them.  Each distinct word of a task is encoded once while it is remembered; the
memory is bounded and ends with the task.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .blocks import bound_batches

#: Longest word, in bytes, that is merged by scans.
SHORT = 128
#: Words remembered at once in a task.
REMEMBERED = 1 << 19
#: Words of up to so many bytes share a matrix.
WIDTHS = (8, 12, 16, 32, SHORT)
#: Characters of texts whose new words are merged together.
RUN = 1 << 20
#: Ids decoded at once.
STRETCH = 1 << 16
#: Rank of a pair that no merge joins.
NEVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte -> the byte.

    Printable Latin-1 stands for itself, the other bytes for the letters from U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class _Known(dict):
    """Ids by word; a word that is not known gives none and is put down in ``asked``."""

    def __init__(self):
        self.asked: set[str] = set()
        self.misses = 0

    def __missing__(self, word: str) -> bytes:
        self.misses += 1
        self.asked.add(word)
        return b""


class ByteBPE:
    """A byte-level BPE tokenizer file (``tokenizers`` JSON).

    ``encode`` gives little-endian unsigned 32-bit ids as bytes.  With
    ``added=True`` the strings of added tokens in a text become their ids;
    without, they are ordinary text.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
                or spec["normalizer"] or spec["post_processor"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain byte-level BPE without normalizer and prefix space")
        letter, vocab = byte_letters(), model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in white space or ask for word bounds are not supported")
        size = 1 + max([*vocab.values(), *added.values()])
        #: bytes of each id, and their number
        self.token = [b""] * size
        for text, i in vocab.items():
            self.token[i] = bytes(letter[c] for c in text)
        for text, i in added.items():
            self.token[i] = text.encode()
        self.length = np.array([len(t) for t in self.token], np.int64)
        self.size = size
        self._bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self._starts = np.cumsum(self.length) - self.length
        self._first = np.array([vocab[c] for c, _ in sorted(letter.items(), key=lambda x: x[1])], np.int32)
        self._rank, merged = {}, []
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self._rank.setdefault(vocab[a] << 32 | vocab[b], r)
            merged.append(vocab[a + b])
        self._merged = np.array([*merged, 0], np.int32)
        self._pairs = np.array([*sorted(self._rank), 1 << 62], np.int64)
        self._pair_ranks = np.array([*(self._rank[p] for p in sorted(self._rank)), NEVER], np.int64)
        self._first_ranks = self._ranks(*np.meshgrid(self._first, self._first, indexing="ij"))
        self._words = regex.compile(pattern)
        # of two added tokens that begin at one place the longer is taken
        self._added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        names = sorted(added, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._known = _Known()

    def ranks(self) -> dict[bytes, int]:
        """Ids by the bytes of the tokens that merges make, for libraries that take ids for ranks."""
        if (np.diff(self._merged[:-1]) <= 0).any():
            raise ValueError("ids do not ascend as the merges do")
        return {self.token[i]: i for i in [*self._first.tolist(), *self._merged[:-1].tolist()]}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._pair_ranks[at], NEVER).astype(np.int32)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of short words by scans of their contiguous rank arrays.

        A word is a row of two matrices, its parts and the ranks of each part with
        the next; all rows scan, delete and refresh together, and a row leaves once
        its least rank is ``NEVER``.
        """
        width = max(map(len, words), default=0) + 1
        raw = np.frombuffer(np.array(words, f"S{width}").tobytes(), np.uint8).reshape(len(words), width)
        live = np.array([len(w) for w in words], np.int64)[:, None]
        parts = np.where(np.arange(width) < live, self._first[raw], self.size).astype(np.int32)   # size: no part
        ranks = np.full(parts.shape, NEVER, np.int32)
        ranks[:, :-1] = np.where(np.arange(1, width) < live, self._first_ranks[raw[:, :-1], raw[:, 1:]], NEVER)
        out, who = [b""] * len(words), np.arange(len(words))
        while len(who):
            row = np.arange(len(who))
            at = ranks.argmin(1)                      # the leftmost of equal ones
            least = ranks[row, at]
            if (least == NEVER).any():
                done = least == NEVER
                count = (parts[done] < self.size).sum(1) * 4
                step, ids = parts.shape[1] * 4, parts[done].astype("<u4").tobytes()
                for k, (w, n) in enumerate(zip(who[done].tolist(), count.tolist())):
                    out[w] = ids[k * step:k * step + n]
                who, parts, ranks, at, least = who[~done], parts[~done], ranks[~done], at[~done], least[~done]
                row = np.arange(len(who))
                if not len(who):
                    break
            parts[row, at] = self._merged[least]
            keep = np.ones(parts.shape, bool)
            keep[row, at + 1] = False                 # the boundary between the two is gone
            parts = parts[keep].reshape(len(who), -1)
            keep[row, at + 1], keep[row, at] = True, False
            ranks = ranks[keep].reshape(len(who), -1)
            inner = np.flatnonzero(at)
            ranks[inner, at[inner] - 1] = self._ranks(parts[inner, at[inner] - 1], parts[inner, at[inner]])
            inner = np.flatnonzero(at + 1 < parts.shape[1])
            ranks[inner, at[inner]] = self._ranks(parts[inner, at[inner]], parts[inner, at[inner] + 1])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """Ids of a word of any length: linked boundaries, ranks in a heap."""
        rank, merged = self._rank, self._merged
        n = len(word)
        parts = self._first[np.frombuffer(word, np.uint8)].tolist()
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := rank.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:                # one of the two has been merged since
                continue
            parts[i], parts[j] = int(merged[r]), -1
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (s := rank.get(parts[i] << 32 | parts[k])) is not None:
                    heapq.heappush(heap, (s, i, parts[i], parts[k]))
            h = left[i]
            if h >= 0 and (s := rank.get(parts[h] << 32 | parts[i])) is not None:
                heapq.heappush(heap, (s, h, parts[h], parts[i]))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def _learn(self) -> None:
        """Encode the words that were asked for in vain."""
        known = self._known
        new, known.asked = list(known.asked), set()
        raw = [w.encode() for w in new]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        for low, high in zip((0, *WIDTHS), WIDTHS):
            some = np.flatnonzero((size > low) & (size <= high)).tolist()
            known.update(zip([new[i] for i in some], self.merge_short([raw[i] for i in some])))
        known.update((new[i], self.merge_long(raw[i])) for i in np.flatnonzero(size > SHORT).tolist())

    def encode(self, texts: list[str], added: bool = True) -> list[bytes]:
        """Ids of whole texts; the new words of a run of texts are merged together."""
        known, out, late, size = self._known, [], [], 0

        def joined(pieces):
            return b"".join(b"".join(map(known.__getitem__, p)) if isinstance(p, list) else p for p in pieces)

        for n, text in enumerate(texts, 1):
            parts = self._cut.split(text) if added and self._cut else [text]
            pieces = [self._added[p] if added and p in self._added else self._words.findall(p) for p in parts]
            misses = known.misses
            out.append(joined(pieces))
            if known.misses > misses:
                late.append((len(out) - 1, pieces))
            size += len(text)
            if size >= RUN or n == len(texts):
                self._learn()
                for i, p in late:
                    out[i] = joined(p)
                late, size = [], 0
                if len(known) > REMEMBERED:
                    known.clear()
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of ids; bytes that are not UTF-8 become U+FFFD."""
        every = np.frombuffer(b"".join(ids), "<u4")
        size = self.length[every]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = []
        for i in range(0, len(every), STRETCH):
            some, at = every[i:i + STRETCH], ends[:-1][i:i + STRETCH]
            n = size[i:i + STRETCH]
            # byte k of the output is byte k - (start of its token there) + (start of its token in the vocabulary)
            raw.append(self._bytes[np.arange(at[0], at[-1] + n[-1]) + np.repeat(self._starts[some] - at, n)].tobytes())
        raw = b"".join(raw)
        cuts = ends[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def _mapped(df: DataFrame, col: str, carry: list[str], out: str, fn) -> DataFrame:
    """(row struct of ``carry``, the columns of ``out``): ``fn`` turns a list of values into arrays, batch by batch."""
    def run(batches):
        work = fn()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1))], names=names)

    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    source = df.select(row, F.col(f"`{col}`").alias("value"))
    names = ["row", *[x.split()[0] for x in out.split(", ")]]
    bound_batches(df.sparkSession)
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, {out}")


def encode(df: DataFrame, text: str, path: str, pattern: str, carry: list[str], added: bool = True) -> DataFrame:
    """Encode every whole text: (row struct of ``carry``, n_tokens long, ids binary).

    ``ids`` are little-endian unsigned 32-bit numbers.  A null or empty text has
    none; a text of any length is one row; repeated rows stay; an empty table
    gives an empty one.  Carried columns lie in ``row``, so no name clashes.
    """
    def work():
        bpe = ByteBPE(path, pattern)

        def one(column):
            ids = bpe.encode([x or "" for x in column.to_pylist()], added)
            return pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())
        return one

    return _mapped(df, text, carry, "n_tokens long, ids binary", work)


def decode(df: DataFrame, ids: str, path: str, pattern: str, carry: list[str]) -> DataFrame:
    """Decode ids as ``encode`` writes them: (row struct of ``carry``, text string); null ids give an empty text."""
    def work():
        bpe = ByteBPE(path, pattern)
        return lambda column: [pa.array(bpe.decode([x or b"" for x in column.to_pylist()]), pa.string())]

    return _mapped(df, ids, carry, "text string", work)
