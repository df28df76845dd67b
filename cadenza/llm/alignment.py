"""Alignment of two tokenizers over the same bytes (operator 13).

Both encodings of a text cover the bytes of a space and the text.  A token-byte
incidence matrix has a row per token and a column per byte, in CSR form (row
pointers and column numbers, built here); the row products of A with the
transpose of B give one entry per pair of tokens that share bytes, the overlap
links.  Offsets where tokens of both end cut the tokens into groups, and the
product of the two token-group incidence matrices gives the shared-group links.

Neither encoding has a token across a cut between a character that is not white
space and a space, so both matrices are block diagonal over the parts between
such cuts, and so are their products.  Documents are encoded once, in blocks of
texts; the products are formed once per distinct part of a block, and a
document's figures are sums over its sequence of parts.

A block counts, by document, the distinct id pairs that are linked, keeps every
document's sequence and every part's links, and sends each pair once to a
bucket of pairs; buckets add up and answer.  The highest
count of each A id is one number per entry of A's vocabulary, whatever the
corpus, so it may travel with the tasks.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .blocks import BUCKET_BYTES, KEYS_SCHEMA, bound_batches, from_stream, join_reply, key_slices, slices, to_stream
from .byte_bpe import ByteBPE
from .text import mix

#: Entries of a product that are expanded at once.
PRODUCT = 1 << 20
#: Text bytes of a block; a longer text is a block alone.
BLOCK_TEXT = 2 << 20
#: Parts remembered at once in a task.
REMEMBERED = 1 << 17
#: A space after a character that is not white space begins a part.
PART = r" \s*\S*(?:[^\S ]\s*\S*)*"
#: An id takes so many bits of a pair's key; the other bits name the bucket.
ID_BITS = 20
NUMBERS = ("seq", "n_parts", "pair", "n_links", "id")


class CSR:
    """A sparse matrix of counts: row pointers, column numbers, number of columns (all entries 1 unless ``values``)."""

    def __init__(self, ptr: np.ndarray, col: np.ndarray, columns: int, values: np.ndarray | None = None):
        self.ptr, self.col, self.columns, self.values = ptr, col, columns, values

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1

    @classmethod
    def intervals(cls, ends: np.ndarray, columns: int) -> "CSR":
        """Row i holds the columns from ``ends[i - 1]`` to ``ends[i]``."""
        return cls(np.concatenate([[0], ends]), np.arange(columns, dtype=np.int64), columns)

    @classmethod
    def owners(cls, ends: np.ndarray, columns: int) -> "CSR":
        """The transpose of ``intervals``: row b holds the interval that covers b."""
        size = np.diff(ends, prepend=0)
        return cls(np.arange(columns + 1), np.repeat(np.arange(len(ends)), size), len(ends))


def products(a: CSR, b: CSR):
    """Gustavson's row products of ``a`` and ``b``, as CSR parts for consecutive runs of rows of ``a``.

    Row i of the product adds up the rows of ``b`` that row i of ``a`` names.  Runs
    are cut so that about PRODUCT entries are expanded at once; a longer row is
    expanded alone.
    """
    width = np.diff(b.ptr)
    reach = np.concatenate([[0], np.cumsum(width[a.col])])      # expanded entries before each entry of a
    before = reach[a.ptr]
    i = 0
    while i < a.rows:
        j = max(i + 1, int(np.searchsorted(before, before[i] + PRODUCT, "right")) - 1)
        named = a.col[a.ptr[i]:a.ptr[j]]
        n = width[named]
        place = np.arange(before[j] - before[i]) + np.repeat(b.ptr[named] - (np.cumsum(n) - n), n)
        row = np.repeat(np.arange(j - i), np.diff(before[i:j + 1]))
        key = row * b.columns + b.col[place]
        if (key[1:] < key[:-1]).any():
            key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        row, col = np.divmod(key[first], b.columns)
        ptr = np.searchsorted(row, np.arange(j - i + 1))
        yield i, CSR(ptr, col, b.columns, np.diff(np.append(first, len(key))))
        i = j


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token pairs (of A, of B) whose byte ranges overlap; ``ends``: byte offsets where the tokens end."""
    total = int(ends_a[-1]) if len(ends_a) else 0
    left, right = [], []
    for at, part in products(CSR.intervals(ends_a, total), CSR.owners(ends_b, total)):
        left.append(at + np.repeat(np.arange(part.rows), np.diff(part.ptr)))
        right.append(part.col)
    return np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of each A token, of each B token, byte offset where each group ends)."""
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), cuts


def group_links(group_a: np.ndarray, group_b: np.ndarray, n: int):
    """Shared-group links as CSR parts: (first A token, part), from the product of the group incidences."""
    a = CSR(np.arange(len(group_a) + 1), group_a, n)
    b = CSR(np.searchsorted(group_b, np.arange(n + 1)), np.arange(len(group_b)), len(group_b))     # groups ascend
    return products(a, b)


class Encoders:
    """Both tokenizers, for the parts of texts: little-endian unsigned 32-bit ids as bytes.

    ``path_a`` names a byte-level BPE file whose ids ascend as its merges do, ``path_b`` a ``sentencepiece``
    model without normalization, whose pieces hold white space at their front only.
    """

    def __init__(self, path_a: str, pattern: str, path_b: str):
        import sentencepiece
        import tiktoken
        bpe = ByteBPE(path_a, pattern)
        self._a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=bpe.ranks(), special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        whole = [not self._b.is_byte(i) for i in range(len(names))]
        if any("\u2581" in p.lstrip("\u2581") for p, w in zip(names, whole) if w):
            raise ValueError(f"{path_b} has pieces with a space inside: texts cannot be cut before spaces")
        self.token_b = [p.replace("\u2581", " ").encode() if w else bytes([int(p[3:5], 16)]) for p, w in zip(names, whole)]
        self.length_a, self.length_b = bpe.length, np.array([len(t) for t in self.token_b], np.int64)
        self._space = self._b.piece_to_id("\u2581")
        self._known: dict[str, tuple[bytes, bytes] | None] = {}

    def encode(self, parts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both for each part; None where their bytes are not those of the part."""
        known = self._known
        new = [p for p in parts if p not in known]
        if new:
            if len(known) > REMEMBERED:
                known.clear()
                new = parts
            # the model puts the first space in front itself, but not to an empty text
            second = self._b.encode([p[1:] for p in new], num_threads=1)
            for p, b in zip(new, second):
                b = b or [self._space]
                same = b"".join(map(self.token_b.__getitem__, b)) == p.encode()
                known[p] = (np.array(self._a.encode_ordinary(p), "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else None
        return list(map(known.__getitem__, parts))


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _ids(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number of ids of each value)."""
    return np.frombuffer(b"".join(values), "<u4").astype(np.int64), np.array([len(x) // 4 for x in values], np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, ``counts`` values each."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Parts:
    """The distinct parts of a block's texts on one axis of bytes; no link crosses from one part to another.

    ``seq`` numbers the parts of all texts, ``n_parts`` of them for each text.
    """

    def __init__(self, ids: list[tuple[bytes, bytes]], seq: np.ndarray, n_parts: np.ndarray, length_a: np.ndarray, length_b: np.ndarray):
        self.seq, self.n_parts = seq, n_parts
        self.a, self.n_a = _ids([x for x, _ in ids])
        self.b, self.n_b = _ids([x for _, x in ids])
        self.ends_a, self.ends_b = np.cumsum(length_a[self.a]), np.cumsum(length_b[self.b])
        self.link_a, self.link_b = links(self.ends_a, self.ends_b)
        part = np.repeat(np.arange(len(ids)), self.n_a)[self.link_a]
        self.n_links = np.bincount(part, minlength=len(ids))
        self.first_link = np.cumsum(self.n_links) - self.n_links
        #: distinct linked id pairs, and the place of each link's pair among them
        self.pairs, self.pair = np.unique(self.a[self.link_a] << ID_BITS | self.b[self.link_b], return_inverse=True)

    def links_of(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of links of each of ``parts``, places of all their links)."""
        n = self.n_links[parts]
        return n, np.arange(n.sum()) + np.repeat(self.first_link[parts] - (np.cumsum(n) - n), n)

    def documents_of_pairs(self) -> np.ndarray:
        """In how many texts of the block each distinct pair is linked."""
        doc = np.repeat(np.arange(len(self.n_parts)), self.n_parts)
        held = np.unique(doc << 32 | self.seq)                                # distinct parts of each text
        n, place = self.links_of(held & 0xFFFFFFFF)
        once = np.unique(np.repeat(held >> 32, n) << 32 | self.pair[place])
        return np.bincount(once & 0xFFFFFFFF, minlength=len(self.pairs))

    def token_links(self) -> dict[str, pa.Array]:
        """Token numbers of each text's links."""
        n, place = self.links_of(self.seq)
        ends = pa.array(np.concatenate([[0], np.cumsum(_sums(n, self.n_parts))]).astype(np.int32))
        out = {}
        for name, token, size in (("link_a", self.link_a, self.n_a), ("link_b", self.link_b, self.n_b)):
            before = np.cumsum(size[self.seq]) - size[self.seq]               # tokens of the block's texts before each part
            base = np.repeat(np.append(before, 0)[np.cumsum(self.n_parts) - self.n_parts], self.n_parts)
            shift = before - base - (np.cumsum(size) - size)[self.seq]
            out[name] = pa.ListArray.from_arrays(ends, pa.array((token[place] + np.repeat(shift, n)).astype(np.int32)))
        return out

    def groups(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Per part: its groups, its shared-group links, and the groups as text."""
        n_parts = len(self.n_a)
        group_a, group_b, cuts = groups(self.ends_a, self.ends_b)
        n = len(cuts)
        part = np.repeat(np.arange(n_parts), self.n_a)
        shared = np.zeros(n_parts, np.int64)
        for at, some in group_links(group_a, group_b, n):
            shared += np.bincount(np.repeat(part[at:at + some.rows], np.diff(some.ptr)), minlength=n_parts)
        count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        # a group's A tokens stand before its B tokens
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + (np.cumsum(count_b) - count_b)[group_a]] = self.a
        order[np.arange(len(self.b)) + np.cumsum(count_a)[group_b]] = self.b
        # a comma follows a token, a bar the last A token of a group, a semicolon the last B token
        mark, ends = np.zeros(len(order), np.int64), np.cumsum(count_a + count_b)
        mark[ends - count_b - 1], mark[ends - 1] = 1, 2
        names, back = np.unique(order * 3 + mark, return_inverse=True)
        token = [b"%d%c" % (v // 3, b",|;"[v % 3]) for v in names.tolist()]
        every = list(map(token.__getitem__, back.tolist()))
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        n_groups = np.bincount(part[np.searchsorted(group_a, np.arange(n))], minlength=n_parts)
        return n_groups, shared, [b"".join(every[i:j])[:-1] for i, j in zip([0, *stops], stops)]


def _pair_keys(pairs: np.ndarray, bits: int) -> np.ndarray:
    """Keys of pairs: the bucket's bits above the pair itself."""
    return (mix(pairs.astype(np.uint64)) >> np.uint64(64 - bits)) << np.uint64(64 - bits) | pairs.astype(np.uint64)


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers below 2 ** 32 by planes of bytes, compressed here: rows of several megabytes fill the JVM's heap."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unplanes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def encode_blocks(df: DataFrame, text: str, path_a: str, pattern: str, path_b: str, carry: list[str], bits: int,
                  keep: tuple[str, ...]) -> DataFrame:
    """Written blocks of all texts: (block, docs, seq, n_parts, pair, n_links, id, keys, counts).

    ``docs``: an Arrow stream of the texts' figures that need no other block; ``seq``, ``n_parts``: each text's
    parts; ``pair``, ``n_links``: each part's links, as numbers of the block's sorted ``keys``; ``id``: the
    A id of each key; ``counts``: the texts that hold it linked.
    """
    def block(batch, encoders, cut):
        """One block's row; what it takes is free before the next block."""
        numbers = _Numbers()
        seqs = [np.array([*map(numbers.__getitem__, cut.findall(" " + x))], np.int64) if x else np.zeros(0, np.int64)
                for x in batch.column(1).to_pylist()]
        ids = encoders.encode(list(numbers))
        del numbers
        if None in ids:
            broken = np.array([x is None for x in ids])
            seqs = [x[:0] if broken[x].any() else x for x in seqs]
            ids = [x or (b"", b"") for x in ids]
        x = Parts(ids, np.concatenate(seqs), np.array([len(s) for s in seqs]), encoders.length_a, encoders.length_b)
        n_groups, shared, texts = x.groups()
        parts = {"n_a": x.n_a, "n_b": x.n_b, "n_groups": n_groups, "n_links": x.n_links, "n_group_links": shared}
        docs = {"row": batch.column(0), **{k: pa.array(_sums(v[x.seq], x.n_parts), pa.int64()) for k, v in parts.items()}}
        every, stops = list(map(texts.__getitem__, x.seq.tolist())), np.cumsum(x.n_parts).tolist()
        texts = [b";".join(every[i:j]) for i, j in zip([0, *stops], stops)]
        docs["groups_sha256"] = pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts])
        if "groups" in keep:
            docs["groups"] = pa.array(texts, pa.binary()).cast(pa.string())
        if "links" in keep:
            docs |= x.token_links()
        keys = _pair_keys(x.pairs, bits)
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return pa.RecordBatch.from_pydict({
            "docs": [to_stream(pa.table(docs))], "seq": [_planes(x.seq)], "n_parts": [_planes(x.n_parts)],
            "pair": [_planes(rank[x.pair])], "n_links": [_planes(x.n_links)], "id": [_planes((x.pairs >> ID_BITS)[order])],
            "keys": [zstandard.compress(keys[order].tobytes(), 1)], "counts": [_planes(x.documents_of_pairs()[order])]}, schema=schema)

    def run(batches):
        encoders, cut = Encoders(path_a, pattern, path_b), re.compile(PART)
        for whole in batches:
            for batch in slices(whole, BLOCK_TEXT):
                yield block(batch, encoders, cut)

    names = ["docs", "seq", "n_parts", "pair", "n_links", "id", "keys", "counts"]
    schema = pa.schema([(n, pa.binary()) for n in names])
    bound_batches(df.sparkSession)
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").alias("text"))
    rows = source.mapInArrow(run, ", ".join(f"{n} binary" for n in names))
    return cut_lineage(rows.withColumn("block", F.monotonically_increasing_id()), "alignment")


def _add_up(table: pa.Table) -> pa.Table:
    """A bucket of pairs: answers in the order of the keys sent, and the highest count of each A id in one row."""
    sent = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    local = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
    every = np.concatenate(sent)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    total = np.add.reduceat(local[order], np.flatnonzero(new))
    answers = np.empty(len(every), np.int64)
    answers[order] = total[np.cumsum(new) - 1]
    # keys ascend by pair, so pairs of one A id stand together
    ids = ranked[new] >> np.uint64(ID_BITS) & np.uint64((1 << ID_BITS) - 1)
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    ends, rest = np.cumsum([len(x) for x in sent]), len(sent) - 1
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "counts": pa.array([answers[e - len(x):e].astype("<u4").tobytes() for x, e in zip(sent, ends)], pa.binary()),
                     "id": pa.array([ids[first].astype(np.int64).tolist(), *[[]] * rest], pa.list_(pa.int64())),
                     "best": pa.array([np.maximum.reduceat(total, first).tolist(), *[[]] * rest], pa.list_(pa.int64()))})


def align(df: DataFrame, text: str, path_a: str, pattern: str, path_b: str, carry: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Align the tokens of A and B in every whole text.

    Returns (row struct of ``carry``, n_a, n_b, n_groups, n_links, n_group_links long, groups_sha256 string,
    n_best, count_sum long).  ``n_best`` counts the links whose id pair is linked in as many texts as any
    pair of its A id, ``count_sum`` adds up those texts over the links.  ``keep`` may name "groups" (string:
    the ids as ``a1,a2|b1;a3|b2,b3``, which the digest is of) and "links" (``link_a``, ``link_b`` array<int>:
    token numbers of the overlap links).

    A null or empty text, and one whose ids do not give back a space and the text, has no tokens: zeros and
    empty groups, with an empty digest.  Repeated rows count as texts of their own; an empty table gives an
    empty one; carried columns lie in ``row``, so no name clashes.
    """
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    want = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size / BUCKET_BYTES, 2)
    bits = min(int(np.ceil(np.log2(want))), 64 - 2 * ID_BITS)
    blocks = encode_blocks(df, text, path_a, pattern, path_b, carry, bits, keep)
    kind = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")).schema["row"].dataType.simpleString()

    def send(batches):
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "counts"))):
                yield key_slices(block, np.frombuffer(zstandard.decompress(keys), np.uint64), _unplanes(counts).astype("<u4"), bits)

    replies = blocks.select("block", "keys", "counts").mapInArrow(send, KEYS_SCHEMA).groupBy("bucket").applyInArrow(
        _add_up, "block long, bucket long, counts binary, id array<bigint>, best array<bigint>")
    replies = cut_lineage(replies, "alignment-replies")
    pairs = replies.select(F.explode(F.arrays_zip("id", "best")).alias("p"))
    best = np.zeros(1 << ID_BITS, np.int64)
    for r in pairs.groupBy("p.id").agg(F.max("p.best").alias("best")).collect():       # one row per entry of A's vocabulary
        best[r.id] = r.best
    best = best[:int(np.flatnonzero(best).max(initial=0)) + 1]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, at = from_stream(left.column("docs")[0].as_py()), {c: _unplanes(left.column(c)[0].as_py()) for c in NUMBERS}
        count = join_reply(right, "<u4").astype(np.int64)
        per_link, is_best = count[at["pair"]], (count == best[at["id"]])[at["pair"]]
        for name, values in (("n_best", is_best), ("count_sum", per_link)):
            docs = docs.append_column(name, pa.array(_sums(_sums(values, at["n_links"])[at["seq"]], at["n_parts"]), pa.int64()))
        return docs

    schema = f"row {kind}, " + ", ".join(f"{k} long" for k in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")) + ", groups_sha256 string"
    schema += ", groups string" * ("groups" in keep) + ", link_a array<int>, link_b array<int>" * ("links" in keep)
    return blocks.select("block", "docs", *NUMBERS).groupBy("block").cogroup(replies.select("block", "bucket", "counts").groupBy("block")) \
        .applyInArrow(finish, schema + ", n_best long, count_sum long")
