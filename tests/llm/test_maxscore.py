"""MaxScore against full scoring."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import maxscore as M
from cadenza.llm.queries import QUERIES, SQL


def brute(ids, vectors, asks, k):
    out = set()
    for i, v in zip(ids, vectors):
        if asks(i):
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in zip(ids, vectors) if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found)}
    return out


@pytest.mark.parametrize("dims,size,sparse", [(8, 3, .0), (16, 20, .0), (32, 9, .8), (1, 2, .5)])
def test_shard_search_is_exact(monkeypatch, dims, size, sparse):
    monkeypatch.setattr(M, "RUNS", (16, 32))
    rng = np.random.default_rng(dims)
    v = rng.integers(-size, size + 1, (300, dims)) * (rng.random((300, dims)) >= sparse)
    v[50:80] = v[10]                                        # ties
    ids = rng.permutation(1000)[:300]
    q, d, s = M.search_shard(ids[:40], v[:40], ids, v, 7)
    got = {}
    for a, b, c in zip(q, d, s):
        got.setdefault(int(ids[a]), []).append((int(ids[b]), int(c)))
    want = brute(ids.tolist(), v.tolist(), lambda i: i in set(ids[:40].tolist()), 7)
    assert {(i, r + 1, *x) for i, xs in got.items() for r, x in enumerate(xs)} == want


@pytest.mark.parametrize("kind,scale", [(np.float32, 1), (np.float64, 1000), (np.int64, 1 << 26)])
def test_pairs_that_reach_the_threshold(kind, scale):
    """Sparse and dense lists, thresholds from none to out of reach."""
    rng = np.random.default_rng(3)
    v = np.zeros((2000, 50), np.int64)
    v[np.arange(2000), rng.integers(0, 50, 2000)] = rng.integers(1, 50, 2000)
    v[1000:] += rng.integers(-9, 10, (1000, 50))
    queries = rng.integers(-5, 6, (6, 50)) * scale
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    threshold = np.array([-np.inf, -3.0 * scale, 0, 100 * scale, 250 * scale, 1e18])
    q, d, s = M.Postings(v, kind).search(np.concatenate([up, down], 1).astype(kind), np.concatenate([down, up], 1).astype(kind), threshold)
    full = queries @ v.T
    assert {(a, b, c) for a, b, c in zip(q, d, s)} == {(a, b, full[a, b]) for a in range(6) for b in np.flatnonzero(full[a] >= threshold[a])}


def test_large_components_stay_exact():
    rng = np.random.default_rng(4)
    v = rng.integers(-(1 << 27), 1 << 27, (40, 6))
    ids = np.arange(40)
    q, d, s = M.search_shard(ids, v, ids, v, 5)
    assert all(sum(int(x) * int(y) for x, y in zip(v[a], v[b])) == c for a, b, c in zip(q, d, s.tolist()))


def test_blocks_and_shards_merge(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD", 50)
    monkeypatch.setattr(M, "QUERY_BLOCK", 7)
    rng = random.Random(1)
    rows = [(i, [rng.randint(-9, 9) for _ in range(rng.choice([4, 6]))]) for i in range(200)]
    extra = [(None, [1, 2]), (500, None), (501, [1, None]), (rows[3][0], rows[3][1]), (20, [100] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows + extra], "vec_id long, v array<int>, score int")
    vectors = {}
    for i, v in rows + [extra[4]]:
        vectors[i] = min(vectors.get(i, v), v)
    got = M.top_k(df, "vec_id", "v", F.col("id") % 5 == 0, 12).collect()
    assert {tuple(r) for r in got} == brute(list(vectors), list(vectors.values()), lambda i: i % 5 == 0, 12)
    few = M.top_k(df.filter("vec_id < 3"), "vec_id", "v", F.lit(True), 12).collect()
    assert len(few) == 6 and M.top_k(df.limit(0), "vec_id", "v", F.lit(True), 5).count() == 0


def test_components_of_any_size(spark, monkeypatch):
    """Large vectors among small ones, over several shards: exact ranks, scores at the ends of a long."""
    monkeypatch.setattr(M, "SHARD", 9)
    monkeypatch.setattr(M, "RUNS", (4,))
    rng = random.Random(2)
    rows = [(i, [rng.randint(-9, 9) for _ in range(5)]) for i in range(30)]
    rows += [(30 + i, [rng.choice([-1, 1]) << rng.randint(27, 63) for _ in range(4)] + [rng.randint(-9, 9)]) for i in range(10)]
    rows += [(40, [1 << 31, 0, 0, 0, 0]), (41, [1 << 32, 0, 0, 0, 0]), (42, [-(1 << 63), 0, 0, 0, 1]), (43, [-(1 << 62)] * 5), (44, [1 << 62] * 5), (45, [1 << 62] * 5)]
    rows = [(i, [min(x, (1 << 63) - 1) for x in v]) for i, v in rows]
    want = brute(*zip(*rows), lambda i: i % 2 == 0, 8)
    want = {(q, r, d, min(max(s, -(1 << 63)), (1 << 63) - 1)) for q, r, d, s in want}
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    assert {tuple(r) for r in M.top_k(df, "vec_id", "v", F.col("id") % 2 == 0, 8).collect()} == want
    # doubles hold whole numbers far above 2**63
    wide = [(i, [float(x) * 2.0 ** (90 * (i % 3)) for x in v]) for i, v in rows if i < 30] \
        + [(50, [1e300] * 5), (51, [-1e300] * 5), (52, [float("inf")] * 5), (53, [float("nan")] * 5)]
    df = spark.createDataFrame(wide, "vec_id long, v array<double>")
    whole = [(i, [int(x) for x in v]) for i, v in wide if i < 52]
    want = {(q, r, d, min(max(s, -(1 << 63)), (1 << 63) - 1)) for q, r, d, s in brute(*zip(*whole), lambda i: i % 2 == 0, 8)}
    assert {tuple(r) for r in M.top_k(df, "vec_id", "v", F.col("id") % 2 == 0, 8).collect()} == want


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = Counter(con.execute(SQL["op2_maxscore"]).fetchall())
    assert Counter(tuple(r) for r in QUERIES["op2_maxscore"](spark, sf).collect()) == want
