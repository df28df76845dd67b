"""Best-fit packing with certified bounds and exchange between partitions (operator 5).

``token_pieces`` encodes documents and cuts those above the capacity.  ``pack``
deals the pieces to groups of bounded size; each group packs best-fit
decreasing, and a lower bound on its bins is certified by dual feasible
functions over its lengths.  Groups that miss their bound give up every bin that
is not full, the others their loosest bins; the pieces given up are dealt to
new groups and packed again, for as long as that saves bins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from . import blocks as B
from .text import Words, _LOWER

GROUP = 1 << 16
#: A bin of a certified group below this share of the capacity is offered for exchange.
LOOSE = 0.95
MEMO = 1_200_000
_TOKENIZERS: dict = {}


# Classes of bytes that the tokenizer's pattern keeps apart inside a word: letters, single digits, other ASCII.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2


class _Encoder:
    """Ids of words, remembered within a worker: the first MEMO runs for good, others for a batch.

    White space never stands inside a token of this tokenizer, and inside a word
    its pattern parts letters, digits and other signs.  So a text's ids are
    those of its runs of one class, known by a 64-bit hash, A-Z folded as the
    tokenizer does itself.  A word with an apostrophe, a sign that may open a
    special token's name, a control byte or letters beyond the Latin ones (which
    may change when composed or folded) stays whole and as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_id = next((t.content, i) for i, t in sorted(added.items()) if t.special)
        self.opening = self.mark[:1].encode()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)          # tokens that end a run
        self.last[[i for t, i in vocabulary.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        # what is known: sorted hashes, and where their ids lie in one buffer (about 30 bytes a run)
        self.keys = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0

    def _runs(self, column) -> tuple[Words, np.ndarray]:
        """Words cut into runs of one class, folded; whether a run is a word that stays as it is."""
        w = Words(column)
        data, n = w.data, len(w.data)
        odd = (data == 0x27) | (data == self.opening[0]) | (data >= 0xCA) | (data == 0xC2) | (data == 0x7F) | ((data < 0x20) & (data != 0x0A))
        pair = data[:-1].astype(np.uint16) << 8 | data[1:]
        odd[:-1] |= (pair == 0xC397) | (pair == 0xC3B7) | (pair == 0xC4B0)         # signs among the letters; one that folds to two
        seen = np.concatenate([[0], np.cumsum(odd)])
        whole = seen[w.ends] > seen[w.starts]
        kind = _CLASS[data]
        inner = np.zeros(n + 1, bool)                                             # inside a word, not at its start
        inner[:-1] = np.cumsum(np.bincount(w.starts, minlength=n + 1) - np.bincount(w.ends, minlength=n + 1))[:n] > 0
        inner[w.starts] = False
        inner[1:n] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cuts = np.flatnonzero(inner)
        cuts = cuts[~whole[np.searchsorted(w.starts, cuts, "right") - 1]]
        raw = [(a, data[a:b].copy()) for a, b in zip(w.starts[whole].tolist(), w.ends[whole].tolist())]
        w.data = _LOWER[data]
        for a, kept in raw:
            w.data[a:a + len(kept)] = kept
        starts = np.sort(np.concatenate([w.starts, cuts]))
        as_is = np.zeros(len(starts), bool)
        as_is[np.searchsorted(starts, w.starts[whole])] = True
        w.starts, w.ends = starts, np.sort(np.concatenate([w.ends, cuts]))
        w.ptr = np.searchsorted(starts, w.offsets)
        return w, as_is

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _split_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs that were encoded in one text, cut behind each token that ends a run."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        cuts = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()]
        if len(cuts) != len(runs) + 1:
            raise ValueError("a run of one class is not one word of the tokenizer")
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])]

    def _split_marked(self, words: list[bytes]) -> list[bytes]:
        """Ids of any words without a special token, kept apart by one."""
        ids = self._plain(self.mark.join(w.decode() for w in words))
        cuts = [-1, *np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
        if len(cuts) != len(words) + 1:
            raise ValueError("the tokenizer's special token is not kept apart")
        return [ids[a + 1:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _ids(self, words: list[bytes], as_is: list[bool]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each run or word."""
        out: list[bytes] = [b""] * len(words)
        runs, odd = [], []
        for i, (w, whole) in enumerate(zip(words, as_is)):
            if not whole:
                runs.append(i)
            elif self.opening in w:
                out[i] = self._plain(w.decode()).tobytes()
            else:
                odd.append(i)
        for some, how in ((runs, self._split_runs), (odd, self._split_marked)):
            for at in range(0, len(some), 1024):
                part = some[at:at + 1024]
                for i, ids in zip(part, how([words[i] for i in part])):
                    out[i] = ids
        return out

    def encode(self, column, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with ``end_id`` behind it; where each text's ids begin, and the end)."""
        w, as_is = self._runs(column)
        codes, keys = pd.factorize(w.hashes() ^ as_is)               # a run never shares its entry with a word that stays as it is
        place = np.searchsorted(self.keys, keys)
        found = np.zeros(len(keys), bool)
        inner = place < len(self.keys)
        found[inner] = self.keys[place[inner]] == keys[inner]
        begin, sizes = np.zeros(len(keys) + 1, np.int64), np.ones(len(keys) + 1, np.int64)
        begin[:-1][found], sizes[:-1][found] = self.start[place[found]], self.size[place[found]]
        fresh = np.flatnonzero(~found)
        first = np.zeros(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        first, raw = first[fresh], w.data.tobytes()
        new = self._ids([raw[a:b] for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist())], as_is[first].tolist())
        new.append(np.array([end_id], "<u4").tobytes())
        size = np.array(list(map(len, new)), np.int64) // 4
        where = np.append(fresh, len(keys))
        begin[where], sizes[where] = self.used + np.cumsum(size) - size, size
        self._hold(np.frombuffer(b"".join(new), "<u4"))
        if len(self.keys) + len(fresh) <= MEMO:
            rank = fresh[np.argsort(keys[fresh])]
            at = np.searchsorted(self.keys, keys[rank])
            self.keys, self.start, self.size = (np.insert(a, at, v.astype(a.dtype)) for a, v in (
                (self.keys, keys[rank]), (self.start, begin[rank]), (self.size, sizes[rank])))
            self.used += int(size[:-1].sum())
        codes = np.insert(codes, w.ptr[1:], len(keys))                 # the end of each text
        size = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(begin[codes] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[w.ptr + np.arange(len(w.ptr))]

    def _hold(self, ids: np.ndarray) -> None:
        """Put ids behind those in use; they stay only if ``used`` moves on."""
        need = self.used + len(ids)
        if need > len(self.flat):
            grown = np.zeros(max(need, 2 * len(self.flat)), "<u4")
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:need] = ids


def token_pieces(df: DataFrame, text_col: str, path: str, carry: list[str], capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of every document's ids (its text's ids, then ``end_id``), written to the shared folder.

    Returns (row struct of ``carry``, item long, piece int from 0, start long,
    length long, ids binary of little-endian unsigned 32-bit ids).  ``item`` is
    unique.  Only documents above ``capacity`` are cut, into pieces of
    ``capacity`` and a rest.  A null or empty text is the end id alone; repeated
    rows and null ids are documents of their own.
    """
    def run(batches):
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = _Encoder(path)
        encoder = _TOKENIZERS[path]
        for whole in batches:
            for batch in B.slices(whole, B.BLOCK_BYTES):
                ids, begin = encoder.encode(batch.column("text"), end_id)
                sizes = np.diff(begin)
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                cuts = (4 * np.concatenate([[0], np.cumsum(length)])).astype(np.int32)          # pieces lie one behind the other
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype("<u4").tobytes())])],
                    names=["row", "piece", "start", "length", "ids"])

    B.bound_batches(df.sparkSession)
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = held.schema["row"].dataType.simpleString()
    pieces = held.mapInArrow(run, f"row {kind}, piece int, start long, length long, ids binary")
    return cut_lineage(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces of these lengths need at least: the best of two families of dual feasible functions.

    f(x) = capacity above capacity - t, x from t on, else 0 (for t up to half);
    g(x) = x where (k + 1) x is a multiple of the capacity, else capacity / k times
    the whole part of (k + 1) x / capacity (for k up to 30).
    """
    if not len(lengths):
        return 0
    n = np.zeros(capacity + 1, np.int64)
    np.add.at(n, lengths, counts)
    upto, weight = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    t = np.arange(0, capacity // 2 + 1)
    low = np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    f = capacity * (upto[-1] - upto[capacity - t]) + weight[capacity - t] - low
    best = int(-(-f.max() // capacity))
    x = np.arange(capacity + 1)
    for k in range(1, 31):
        g = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((g * n).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, packed longest first into the tightest bin that takes it."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, used = 0, 0                      # open_rooms: bit r is set if a bin has room r
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fit = open_rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            rooms[left].append(b)
            open_rooms |= 1 << left
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, rounds: int = 12) -> DataFrame:
    """Sequence of every piece of (item long, length long); lengths are 1 to ``capacity``.

    Returns (item, sequence_id long, offset long: tokens of the sequence before
    the piece, bound long: certified least number of sequences for all pieces).
    Equal lengths are told apart by item, so the result does not depend on how
    rows are dealt.  An empty table gives none.
    """
    kind = "item long, length long, group long, bin long, offset long, offered boolean"

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        lengths = np.asarray(table.column("length"))
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, lengths).astype(np.int64)
        values, counts = np.unique(lengths, return_counts=True)
        certified = len(fill) <= lower_bound(values, counts, capacity)
        offered = fill < (LOOSE * capacity if certified else capacity)
        return pa.table({"item": table.column("item"), "length": table.column("length"), "group": table.column("group"),
                         "bin": bins, "offset": offsets, "offered": offered[bins]})

    def deal(rows: DataFrame, n: int, step: int) -> DataFrame:
        groups = max(1, -(-n // GROUP))
        dealt = rows.select("item", "length", F.pmod(F.xxhash64("item", F.lit(step)), F.lit(groups)).alias("group"))
        return cut_lineage(dealt.groupBy("group").applyInArrow(fit, kind).withColumn("step", F.lit(step)), "packed")

    def opened(rows: DataFrame) -> tuple[int, int]:
        """Pieces and bins."""
        return tuple(rows.agg(F.count("*"), F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))).first())

    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()        # at most `capacity` rows
    bound = lower_bound(np.array([r.length for r in histogram], np.int64), np.array([r.n for r in histogram], np.int64), capacity)
    now = deal(pieces, sum(r.n for r in histogram), 0)
    done = []
    for step in range(1, rounds + 1):
        pool = now.filter("offered")
        items, bins = opened(pool)
        if not items:
            break
        again = deal(pool, items, step)
        if opened(again)[1] >= bins:
            break
        done.append(now.filter("not offered"))
        now = again
    for rows in done:
        now = now.unionByName(rows)
    # a group's pieces are about GROUP, dealt by a hash, so its bins may be more; 2^24 groups of 2^32 bins fit below a step
    sequence = (F.col("step").cast("long") * F.lit(1 << 56)) + F.col("group") * F.lit(1 << 32) + F.col("bin")
    return now.select("item", sequence.alias("sequence_id"), "offset", F.lit(bound).cast("long").alias("bound"))
