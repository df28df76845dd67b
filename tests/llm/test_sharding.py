"""Stratified interleaving: the law, the mixture, and the rows of the SQL."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.llm import sharding
from cadenza.llm.queries import QUERIES, SQL


def deal(df, shards):
    return sharding.interleave(df, F.col("source"), F.col("doc_id"), [F.col("doc_id"), F.col("shard")], shards).collect()


@pytest.mark.parametrize("n,shards,run", [(1000, 24, 4096), (1000, 7, 16), (5, 24, 4), (0, 3, 4)])
def test_law_and_mixture(spark, monkeypatch, n, shards, run):
    monkeypatch.setattr(sharding, "RUN", run)
    rng = random.Random(n + shards)
    rows = [(i if rng.random() < .9 else None, rng.choice(["hot"] * 5 + ["b", "c", None, f"only{i}"]), i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, shard int").repartition(3)
    out = deal(df, shards)
    assert Counter((r.row.doc_id, r.row.source, r.row.shard) for r in out) == Counter(rows)
    sizes = Counter(r.shard for r in out)
    assert set(sizes) <= set(range(shards)) and (n == 0 or max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1)
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    mix = Counter((r.row.source, r.shard) for r in out)
    for source, total in Counter(r.row.source for r in out).items():
        for s in range(shards):
            # one row of its own, and its share of the roundings of a hundred small sources
            assert abs(mix[source, s] - total / shards) < 1 + 10 * total / n
    assert sorted(r.source_rank for r in out if r.row.source == "hot") == list(range(sum(r.row.source == "hot" for r in out)))
    again = deal(df.repartition(5), shards)
    key = lambda rs: Counter((r.row, r.shard, r.slot) for r in rs)
    assert key(again) == key(out)


def test_repeated_rows_are_all_dealt(spark):
    df = spark.createDataFrame([(1, "a", 0)] * 10 + [(None, None, None)] * 3, "doc_id long, source string, shard int")
    out = deal(df, 4)
    assert len(out) == 13 and sorted(Counter(r.shard for r in out).values()) == [3, 3, 3, 4]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(SQL["op3_sharding"])
    names = [d[0] for d in want.description]
    df = QUERIES["op3_sharding"](spark, sf)
    rows = df.collect()
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(want.fetchall())
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.size == len(docs[r.doc_id].encode()) + 8 for r in rows)
