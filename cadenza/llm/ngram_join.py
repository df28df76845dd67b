"""N-gram Jaccard self-join with adaptive multi-match prefixes (operator 7).

Documents are sets of word shingles; two link when their Jaccard similarity
reaches ``num / den``.  Shingles are ordered by document frequency, rarest
first, ties by hash.  The l-prefix of a set of ``n`` shingles is its first
``n - ceil(t * n) + l`` ones; linked sets share at least l of their l-prefixes.

1. Document frequencies of all shingles (``blocks.count_exchange``).  Shingles
   of one document only cannot be shared, yet fill the front of a prefix: a
   document whose prefix holds nothing else has no link and leaves here.
2. Equal sets are one class (one row per class goes on).
3. Classes that share a shingle of their 1-prefixes are joined to the least
   class of that shingle, never to each other; components of this graph hold
   every link.
4. Inside a component, each document takes the prefix length l whose estimated
   cost (postings to read, plus candidates to verify, which fall with l) is
   least.  A pair is verified only if the prefixes share the smaller l of the
   two, and only while its two documents are not yet connected.  Components
   above ``GROUP`` classes are cut into blocks by hash: every block with
   itself and with the first, then, where that left a component in several
   parts, the other pairs of blocks.
5. Components of the links found are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage, discard
from . import blocks as B
from .components import components
from .text import Words, _GRAM, gram_hashes, inside, mix, powers

GROUP = 1024
MOST_MATCHES = 8
#: Cost of verifying a candidate, in postings read.
VERIFY = 64


def shingle_sets(column, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``k``-word shingles; fewer words are one shingle."""
    w = Words(column, lower=True)
    h, ptr = w.hashes(), w.ptr
    grams = gram_hashes(h, k)
    ok = inside(ptr, k)
    sets = []
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            sets.append(mix(np.array([(h[a:b] * powers(_GRAM, b - a)).sum(dtype=np.uint64)], np.uint64) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    assert len(ok) == len(grams)
    return sets


def least_common(n: int, num: int, den: int) -> int:
    """Shingles that a set of ``n`` must share with any set it links to."""
    return -(-num * n // den)


def choose_matches(df: np.ndarray, n: int, unique: int, need: int) -> int:
    """The l of least estimated cost for a set whose shared shingles have frequencies ``df`` (ascending)."""
    best, at = None, 1
    total = np.concatenate([[0], np.cumsum(df)])
    for l in range(1, min(MOST_MATCHES, need) + 1):
        postings = float(total[min(len(df), max(0, n - need + l - unique))])
        cost = postings + VERIFY * postings / l
        if best is None or cost < best:
            best, at = cost, l
    return at


class _Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def roots(self, xs: np.ndarray) -> np.ndarray:
        r = self.up[xs]
        while True:
            nxt = self.up[r]
            if (nxt == r).all():
                return r
            r = nxt

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def spanning_links(n: list[int], unique: list[int], shared: list[np.ndarray], freq: list[np.ndarray], side: list[int],
                   num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect exactly what all links connect, among sets given by their shared shingles
    (rarest first).  ``side``: pairs of the same side are not compared, unless all are of side 0."""
    total = len(n)
    need = [least_common(x, num, den) for x in n]
    match = np.array([choose_matches(freq[i].astype(np.int64), n[i], unique[i], need[i]) for i in range(total)], np.int64)
    prefix = [shared[i][:max(0, n[i] - need[i] + int(match[i]) - unique[i])] for i in range(total)]
    sorted_sets = [np.sort(s) for s in shared]
    sizes, sides = np.array(n, np.int64), np.array(side, np.int64)
    owner = np.repeat(np.arange(total), [len(p) for p in prefix])
    token = np.concatenate(prefix) if total else np.zeros(0, np.uint64)
    order = np.argsort(token, kind="stable")          # postings stay in document order
    token, owner = token[order], owner[order]
    cross = bool(sides.any())
    union, links = _Union(total), []
    for x in range(1, total):
        if not len(prefix[x]):
            continue
        lo, hi = np.searchsorted(token, prefix[x], "left"), np.searchsorted(token, prefix[x], "right")
        met = np.concatenate([owner[a:b] for a, b in zip(lo, hi)])
        hits = np.bincount(met[met < x], minlength=x)
        ys = np.flatnonzero(hits)
        ys = ys[(hits[ys] >= np.minimum(match[ys], match[x]))
                & (den * np.minimum(sizes[ys], sizes[x]) >= num * np.maximum(sizes[ys], sizes[x]))]
        if cross:
            ys = ys[sides[ys] != sides[x]]
        ys = ys[np.argsort(-hits[ys], kind="stable")]
        while len(ys):
            ys = ys[union.roots(ys) != union.root(x)]
            if not len(ys):
                break
            for step, y in enumerate(ys.tolist()):
                both = len(np.intersect1d(sorted_sets[x], sorted_sets[y], assume_unique=True))
                if den * both >= num * (n[x] + n[y] - both):
                    links.append((x, y))
                    union.join(x, y)
                    ys = ys[step + 1:]
                    break
            else:
                break
    return links


def _document_rows(df: DataFrame, text_col: str, carry: list[str], k: int, num: int, den: int) -> DataFrame:
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    blocks = B.pack_blocks(held, tag="ngram-blocks")
    bits = B.bucket_bits(blocks, 0.7)

    def frequencies(sets):
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        keys, counts = np.unique(every, return_counts=True)
        return every, keys, counts.astype(np.uint32)

    def send(block, table):
        _, keys, counts = frequencies(shingle_sets(table.column("text"), k))
        yield B.key_slices(block, keys, counts, bits, wide=False)

    def judge(block, table, replies):
        sets = shingle_sets(table.column("text"), k)
        every, keys, _ = frequencies(sets)
        df_of = B.join_reply(replies, "uint8")[np.searchsorted(keys, every)] if len(every) else np.zeros(0, np.uint8)
        n, unique, s1, s2, shared, freq, at = [], [], [], [], [], [], 0
        for s in sets:
            f = df_of[at:at + len(s)]
            at += len(s)
            common = f >= 2
            n.append(len(s))
            unique.append(int(len(s) - common.sum()))
            s1.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
            s2.append(int(mix(s * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
            if len(s) and common.sum() >= least_common(len(s), num, den):
                order = np.lexsort((s[common], f[common]))
                shared.append(s[common][order].tobytes())
                freq.append(f[common][order].tobytes())
            else:
                shared.append(None)
                freq.append(None)
        return pa.table({"row": table.column("row"), "n": pa.array(n, pa.int64()), "unique": pa.array(unique, pa.int64()),
                         "s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()),
                         "shared": pa.array(shared, pa.binary()), "freq": pa.array(freq, pa.binary())})

    replies = B.count_exchange(B.over_blocks(blocks, send, B.KEYS_SCHEMA), wide=False)
    long = T.LongType()
    schema = T.StructType([T.StructField("row", held.schema["row"].dataType), T.StructField("n", long), T.StructField("unique", long),
                           T.StructField("s1", long), T.StructField("s2", long),
                           T.StructField("shared", T.BinaryType()), T.StructField("freq", T.BinaryType())])
    rows = B.with_replies(blocks, replies, judge, schema)
    out = cut_lineage(rows.withColumn("rid", F.monotonically_increasing_id()), "ngram-rows")
    discard(blocks)
    return out


def _links(nodes: DataFrame, num: int, den: int) -> DataFrame | None:
    """Spanning links (a, b) between classes; None if no two classes are candidates."""
    def first_prefix(batches):
        for batch in batches:
            ids, out = [], []
            for cid, n, u, s in zip(*(batch.column(c).to_pylist() for c in ("cid", "n", "unique", "shared"))):
                p = np.frombuffer(s, np.int64)[:max(0, n - least_common(n, num, den) + 1 - u)]
                ids.append(np.full(len(p), cid))
                out.append(p)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(out), pa.int64())],
                                                 names=["cid", "token"])

    postings = cut_lineage(nodes.select("cid", "n", "unique", "shared").mapInArrow(first_prefix, "cid long, token long"), "ngram-postings")
    heads = postings.groupBy("token").agg(F.min("cid").alias("head"), F.max("cid").alias("tail")).filter("head < tail")
    groups = components(postings.join(heads, "token").filter("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b")))
    groups = cut_lineage(groups, "ngram-groups")
    sizes = groups.groupBy("label").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    members = groups.join(sizes, "label").join(nodes, F.col("node") == F.col("cid")).select(
        "label", "parts", "cid", "n", "unique", "shared", "freq", F.pmod(F.xxhash64("cid"), "parts").cast("int").alias("part"))
    members = cut_lineage(members, "ngram-members")

    def compare(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_pylist() for c in ("cid", "n", "unique", "shared", "freq", "part", "i", "j")}
        order = np.argsort(col["cid"])
        pick = {c: [v[k] for k in order] for c, v in col.items()}
        side = [int(i != j and p == j) for p, i, j in zip(pick["part"], pick["i"], pick["j"])]
        found = spanning_links(pick["n"], pick["unique"], [np.frombuffer(s, np.uint64) for s in pick["shared"]],
                               [np.frombuffer(s, np.uint8) for s in pick["freq"]], side, num, den)
        return pa.table({"a": pa.array([pick["cid"][x] for x, _ in found], pa.int64()),
                         "b": pa.array([pick["cid"][y] for _, y in found], pa.int64())})

    def tasks(rows: DataFrame, partners) -> DataFrame:
        """Each row goes to the tasks (i, j) of its part; i <= j."""
        return rows.withColumn("other", F.explode(partners)).select(
            "*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")).drop("other") \
            .groupBy("label", "i", "j").applyInArrow(compare, "a long, b long")

    every = F.sequence(F.lit(0), F.col("parts") - 1)
    near = F.when(F.col("part") == 0, every).otherwise(F.array(F.lit(0), F.col("part")))
    links = cut_lineage(tasks(members, near), "ngram-links")
    large = members.filter("parts > 1")
    if large.isEmpty():
        return links
    part_of = components(links).withColumnRenamed("label", "root")
    state = large.join(part_of, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    open_groups = state.groupBy("label").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("label")
    rest = F.filter(every, lambda o: (o != 0) & (o != F.col("part")))
    far = tasks(large.join(open_groups, "label", "left_semi").filter("part > 0"), rest)
    return links.unionByName(far)


def jaccard_components(df: DataFrame, id_col: str, text_col: str = "text", k: int = 5, num: int = 80, den: int = 100,
                       carry: list[str] | None = None) -> DataFrame:
    """Exact components of the links ``den * |A & B| >= num * |A | B|`` over ``k``-word shingle sets.

    Words are runs outside ``[\\x20\\x09-\\x0D]`` of the whole text, A-Z folded.  A
    text with fewer than ``k`` words is one shingle; without words (or null) it
    has an empty set and links with nothing.

    Returns one row per input row: (row struct of ``carry``, default the id;
    n_shingles long; component_id, the smallest id reachable, the row's own
    included; rid long, unique; first boolean: whether the row is the one to keep
    of its component, i.e. has the smallest (id, rid), null ids last).  Repeated
    rows and equal texts are one class.  A null id counts for nothing in the
    minimum; a component with null ids only has a null component_id.
    """
    carry = [id_col] if carry is None else list(dict.fromkeys([id_col, *carry]))
    rows = _document_rows(df, text_col, carry, k, num, den)
    ident = F.col("row").getField(id_col)
    classes = cut_lineage(rows.filter("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("rid").alias("cid"), F.min(F.struct(ident.isNull().alias("z"), ident.alias("i"), F.col("rid").alias("r"))).alias("best")), "ngram-classes")
    nodes = rows.filter("shared is not null").join(classes.select("cid"), F.col("rid") == F.col("cid"), "left_semi") \
        .withColumnRenamed("rid", "cid")
    links = cut_lineage(_links(nodes, num, den), "ngram-links")
    labels = components(links)
    narrow = cut_lineage(rows.drop("shared", "freq", "unique"), "ngram-named")
    discard(rows)
    rows = narrow
    joined = classes.join(labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    best = joined.groupBy("label").agg(F.min("best").alias("least"))
    named = joined.join(best, "label").select("s1", "s2", "n", "least")
    return rows.join(named, ["s1", "s2", "n"], "left").select(
        "row", F.col("n").alias("n_shingles"), "rid",
        F.when(F.col("n") > 0, F.col("least.i")).otherwise(ident).alias("component_id"),
        F.when(F.col("n") > 0, F.col("least.r") == F.col("rid")).otherwise(F.lit(True)).alias("first"))
