"""Exact top-k search by MaxScore over integer vectors (operator 2).

A vector is a document whose terms are its dimensions, each once for either
sign: the posting list (dimension, sign) holds the vectors whose component has
that sign.  For a query, the lists on the side of its own component's sign add
to a score and are bounded by the largest component in them; the lists on the
other side only subtract, their bound is 0.  With the best ``k`` scores so far as
threshold, the lists of least bound whose bounds add up to less than it are
non-essential: a vector in none of the essential lists cannot enter.  Essential
postings are traversed; the vectors that can still reach the threshold are
probed in the other lists, those of greater bounds first, and dropped once they
cannot.  Shards of vectors are searched by blocks of queries, and the shards'
best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

SHARD = 4096
QUERY_BLOCK = 512
#: Vectors whose components are all below this in size are held as 64-bit numbers, others as Python's whole numbers.
LIMIT = 1 << 28
#: Scores stay within this on either side: products of two doubles, over some 2**70 dimensions.
WIDEST = 2120
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
#: Vectors of a shard are read in runs of these sizes: a first threshold costs little, later ones prune.
RUNS = (256, 1024)
#: Lists that are probed together at the end.
PROBE = 8


def _matrix(column) -> np.ndarray:
    """Rows of a list column; shorter vectors are filled with zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(pc.list_value_length(rows), dtype=np.int64) if len(rows) else np.zeros(0, np.int64)
    flat = np.asarray(rows.flatten())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), flat.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _by_size(ids: np.ndarray, rows: np.ndarray):
    """(ids, whole numbers) of the vectors below ``LIMIT`` and, apart, of those with a larger component."""
    large = ((rows >= LIMIT) | (rows <= -LIMIT)).any(axis=1)
    if not large.all():
        yield ids[~large], rows[~large].astype(np.int64)
    if large.any():
        whole = np.empty((int(large.sum()), rows.shape[1]), object)
        whole[:] = [[int(x) for x in row] for row in rows[large].tolist()]
        yield ids[large], whole


class Postings:
    """Posting lists of a run of vectors, list (dimension, sign) after list, and each list's largest component.

    Vectors here fill most dimensions, so a list is kept as a row with zeros
    where a vector is not in it, and lists are traversed for a block of queries
    by one matrix product (in whole numbers, exact in the type chosen).
    """

    def __init__(self, vectors: np.ndarray, kind):
        self.lists = np.concatenate([np.maximum(vectors, 0), np.minimum(vectors, 0)], axis=1).T.astype(kind)
        self.bound = np.abs(self.lists).max(axis=1, initial=0)

    def search(self, adding: np.ndarray, taking: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of all pairs that reach the query's threshold.

        ``adding`` / ``taking``: each query's weights of the lists that add to and that subtract from its scores.
        """
        bounds = np.abs(adding) * self.bound
        order = np.argsort(bounds, axis=1, kind="stable")
        below = np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)          # what the lists up to each one can add together
        others = (below < threshold[:, None]).sum(1)                             # so many lists cannot reach the threshold alone
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], 1)

        def left(n: np.ndarray) -> np.ndarray:
            return np.where(n > 0, np.take_along_axis(below, np.maximum(n - 1, 0)[:, None], 1)[:, 0], 0)[:, None]

        columns, goal = np.arange(self.lists.shape[1]), threshold[:, None]
        score = np.where(rank >= others[:, None], adding, 0) @ self.lists        # the essential lists
        alive = score + left(others) >= goal
        while others.any() and len(columns):
            fewer = np.where(others > PROBE, others // 2, 0)                     # of the others, those of greater bounds first
            stay = alive.any(axis=0)
            if not stay.all():
                columns, score, alive = columns[stay], score[:, stay], alive[:, stay]
            score += np.where((rank < others[:, None]) & (rank >= fewer[:, None]), adding, 0) @ self.lists[:, columns]
            alive &= score + left(fewer) >= goal
            others = fewer
        score += taking @ self.lists[:, columns]
        alive &= score >= goal
        q, v = np.nonzero(alive)
        found = score[q, v]
        return q, columns[v], found if found.dtype == object else found.astype(np.int64)


def search_shard(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """Each query's best ``k`` vectors of a shard but its own: (query index, vector index, score) arrays.  Ids differ."""
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, vectors))
    order = np.argsort(ids, kind="stable")                       # ties go to the smaller id, hence to the earlier vector
    ids, vectors = ids[order], vectors[order]
    highest = [np.abs(m).max(axis=0, initial=0).tolist() for m in (queries, vectors)]
    most = sum(x * y for x, y in zip(*highest))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object  # all exact
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    adding, taking = np.concatenate([up, down], axis=1).astype(kind), np.concatenate([down, up], axis=1).astype(kind)
    own = np.searchsorted(ids, query_ids)
    own = np.where(ids[np.minimum(own, len(ids) - 1)] == query_ids, own, -1)
    exact = object if kind is object else np.int64
    threshold = np.full(len(query_ids), -most - 1, exact)        # none yet
    q, v, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, exact)
    cuts = [0, *(c for c in np.cumsum(RUNS).tolist() if c < len(ids)), len(ids)]
    for a, b in zip(cuts, cuts[1:]):
        found = Postings(vectors[a:b], kind).search(adding, taking, threshold)
        keep = found[1] + a != own[found[0]]
        q, v, score = (np.concatenate(x) for x in zip((q, v, score), (found[0][keep], found[1][keep] + a, found[2][keep])))
        height = np.unique(score, return_inverse=True)[1].reshape(-1)
        rank = np.lexsort((v, -height, q))
        q, v, score = q[rank], v[rank], score[rank]
        place = np.arange(len(q)) - np.searchsorted(q, q)        # place among the query's own
        threshold[q[place == k - 1]] = score[place == k - 1]
        q, v, score = q[place < k], v[place < k], score[place < k]
    return q, order[v], score


def _found(query_ids, vec_ids, scores) -> pa.Table:
    """Rows of a shard's best.  ``beyond`` orders the scores at or past the ends of a long, as bytes; null between them."""
    return pa.table({
        "query_id": pa.array(query_ids, pa.int64()), "vec_id": pa.array(vec_ids, pa.int64()),
        "score": pa.array([min(max(s, LONG_MIN), LONG_MAX) for s in scores], pa.int64()),
        "beyond": pa.array([None if LONG_MIN < s < LONG_MAX else (s + (1 << WIDEST)).to_bytes(WIDEST // 8 + 1, "big") for s in scores], pa.binary())})


def top_k(vectors: DataFrame, id_col: str, vector_col: str, is_query, k: int) -> DataFrame:
    """Best ``k`` vectors by integer inner product for every query vector.

    ``vector_col``: array of whole numbers, as integers or as doubles (which hold
    those above 2**63).  Returns (query_id, rank int from 1, vec_id, score long);
    all other vectors, if fewer than ``k``; ties to the smaller id.  Rows without
    an id, without a vector or with a null or non-finite component take no part.
    The id is the key: of rows that repeat one, the least vector counts.  Shorter
    vectors count as zero beyond their end.

    Vectors with a component of 2**28 or more are scored in Python's whole
    numbers, apart from the rest: exact, and slow where many are that large.  A
    score beyond 64 bits is given as the nearest long; ranks and ties follow the
    exact scores.
    """
    kind = vectors.schema[vector_col].dataType.elementType
    fraction = isinstance(kind, (T.FloatType, T.DoubleType))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast(f"array<{'double' if fraction else 'bigint'}>").alias("v"),
                          is_query.alias("asks")) \
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    if fraction:
        rows = rows.filter(~F.exists("v", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    total, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    shards, blocks = max(1, -(-total // SHARD)), max(1, -(-asking // QUERY_BLOCK))

    def spread(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Every row, in its own part of n, goes to each of the m parts of the other side."""
        return df.select("id", "v", F.pmod(F.xxhash64("id", F.lit(own)), F.lit(n)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [_found((), (), ())]
        if asked.num_rows and held.num_rows:
            sides = [list(_by_size(np.asarray(t.column("id")), _matrix(t.column("v")))) for t in (asked, held)]
            for qid, queries in sides[0]:
                for vid, matrix in sides[1]:
                    q, v, score = search_shard(qid, queries, vid, matrix, k)
                    out.append(_found(qid[q], vid[v], score.tolist()))
        return pa.concat_tables(out)

    asked = spread(rows.filter("asks"), "block", blocks, "shard", shards)
    held = spread(rows, "shard", shards, "block", blocks)
    parts = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")) \
        .applyInArrow(run, "query_id long, vec_id long, score long, beyond binary")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id"))
    return parts.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
