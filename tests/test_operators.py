"""Operator semantics on tiny frames."""

from pyspark.sql import functions as F

from cadenza.operators import aggregates as A
from cadenza.operators import derived as D
from cadenza.operators import joins as J
from cadenza.operators import warehouse as W
from cadenza.operators.charts import popularity_by_year


def test_priority_merge(spark):
    base = spark.createDataFrame([(1, None, "x"), (2, "b", None)], "k int, a string, c string")
    other = spark.createDataFrame([(1, "A", "o1"), (1, "A2", "o2"), (3, "C", "o3")], "k int, a string, d string")
    out = sorted(map(tuple, J.priority_merge(base, other, "k").collect()), key=lambda r: (r[0], r[3] or ""))
    assert out == [(1, "A", "x", "o1"), (1, "A2", "x", "o2"), (2, "b", None, None)]


def test_explode_join_keeps_empty(spark):
    t = spark.createDataFrame([(1, [10, 20]), (2, [])], "id int, g array<int>")
    dim = spark.createDataFrame([(10, "rock")], "gid int, title string")
    out = sorted(map(tuple, J.explode_join(t, "g", dim, "gid").select("id", "gid", "title").collect()),
                 key=lambda r: (r[0], r[1] or 0))
    assert out == [(1, 10, "rock"), (1, 20, None), (2, None, None)]


def test_top_n_with_others(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.0), ("d", 1.0)], "l string, v double")
    out = {r["l"]: (r["total"], round(r["share"], 6)) for r in A.top_n_with_others(df, "l", "v", 2).collect()}
    assert out == {"a": (5.0, 50.0), "b": (3.0, 30.0), "Others": (2.0, 20.0)}


def test_leave_one_out(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, 5.0), (2, 7.0)], "k int, v double")
    out = sorted(r["v_loo"] for r in A.leave_one_out_means(df, "k", ["v"]).collect())
    assert out == [2.0, 3.0, 4.0]          # group 2 has one row and is dropped


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([(1, 5, "a", 1), (1, 5, "b", 2), (2, 1, "c", 1)], "k int, ts int, v string, id int")
    out = dict((r["k"], r["v"]) for r in J.latest_per_key(df, "k", "ts", ["v"], tie_cols=["id"]).collect())
    assert out == {1: "b", 2: "c"}


def test_upsert_and_insert_if_absent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, W.upsert(old, new, "k").collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, W.insert_if_absent(old, new, "k").collect())) == [(1, "a"), (2, "b"), (3, "C")]


def test_signed_counter_floor(spark):
    ev = spark.createDataFrame([(1, "insert", 1), (1, "delete", 2), (1, "delete", 3), (2, "insert", 4)], "k int, op string, at int")
    assert dict(map(tuple, D.signed_counter(ev, "k", "op", ["at"]).collect())) == {1: 0, 2: 1}


def test_popularity_smoothing_dense_grid(spark):
    rows = [("g1", "2000-01-01", 1.0), ("g1", "2001-01-01", 3.0), ("g2", "2000-01-01", 10.0),
            ("g2", "2002-01-01", 20.0), ("g1", "2002-01-01", 5.0), (" null ", "2001-01-01", 9.0)]
    df = spark.createDataFrame(rows, "g string, d string, m double").withColumn("d", F.to_date("d"))
    out = {(r["year"], r["g"]): r["value"] for r in
           popularity_by_year(df, "g", "d", "m", agg="mean", top=2, min_year_count=1, smooth_window=2).collect()}
    assert out[(2001, "g2")] == 10.0           # missing cell smoothed from the previous year
    assert out[(2002, "g2")] == 20.0
    assert out[(2001, "g1")] == 2.0


def test_merge_job_writes_csv(spark, tmp_path):
    from cadenza.operators.merge import merge_job
    tracks = spark.createDataFrame([(1, "[10, 20]", None), (2, "[]", 5)], "track_id int, track_genres string, listens int")
    genres = spark.createDataFrame([(10, "rock")], "genre_id int, title string")
    raw = spark.createDataFrame([(1, 7)], "track_id int, raw_listens int")
    out = str(tmp_path / "merged")
    merged = merge_job(tracks, "track_id", "track_genres", genres, "genre_id",
                       [{"df": raw, "key": "track_id"}], fill_from=[("listens", "raw_listens")], out_path=out, fmt="csv")
    back = spark.read.option("header", "true").csv(out)
    rows = sorted((r["track_id"], r["genre_id"], r["listens"], r["track_genres"]) for r in back.collect())
    assert rows == [("1", "10", "7", "[10, 20]"), ("1", "20", "7", "[10, 20]"), ("2", None, "5", "[]")]
    assert merged.count() == 3
