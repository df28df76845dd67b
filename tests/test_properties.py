"""Property tests: parse(format(x)) = x, repartition invariance,
score bounds, kept + removed = total."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.functions import standardise as S
from cadenza.operators import aggregates as A
from cadenza.operators import recommend as R
from cadenza.operators.quality import TableRules, clean_table


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=40))
def test_to_int_roundtrip(spark, values):
    def fmt(i, v):
        s = f"{abs(v):,}" if i % 3 == 0 else (f"{abs(v):_}" if i % 3 == 1 else f" {abs(v)}.0 ")
        return ("-" if v < 0 else "") + s
    df = spark.createDataFrame([(fmt(i, v), v) for i, v in enumerate(values)], "s string, v long")
    out = df.select(S.to_int(F.col("s")).cast("long").alias("p"), "v").collect()
    assert all(r["p"] == r["v"] for r in out)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=2, allow_nan=False), min_size=1, max_size=40))
def test_to_float_roundtrip(spark, values):
    rows = [(str(v).replace(".", ",") if i % 2 else f"{v:,}", float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, v double")
    out = df.select(S.to_float(F.col("s")).cast("double").alias("p"), "v").collect()
    assert all(abs(r["p"] - r["v"]) < 1e-9 for r in out)


def test_repartition_invariance(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    res = set()
    for n in (1, 3, 7):
        df = base.repartition(n)
        out = A.top_n_with_others(df, "o_orderpriority", "o_totalprice", 3)
        res.add(tuple(sorted((r[0], round(r[1], 6), round(r[2], 6)) for r in out.collect())))
    assert len(res) == 1


def test_scores_bounded(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    postings = R.text_postings(part, "p_partkey", {"t": "p_name", "b": "p_brand"})
    numeric = R.numeric_block(part, "p_partkey", ["p_size", "p_retailprice"])
    out = R.item_similarity(postings, numeric, part, "p_partkey", 3, 2, top_n=50).collect()
    assert out and all(-1.0 - 1e-9 <= r["score"] <= 1.0 + 1e-9 for r in out)
    norms = postings.groupBy("item", "comp").agg(F.sum(F.col("w") * F.col("w")).alias("n2")).collect()
    assert all(abs(r["n2"] - 1.0) < 1e-9 for r in norms)


def test_kept_plus_removed_is_total(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("k"), F.col("c_acctbal").cast("string").alias("b"))
    res = clean_table(df, TableRules(validation={"k": ["notNull", "unique", "int"], "b": ["notNegative", "float"]}))
    rep = res.report().collect()[0]
    fails = sum(r["failures"] for r in res.failures().collect())
    assert rep["cleaned_rows"] + fails == rep["filtered_rows"] == df.count()
