"""Source / sink queries: the driver tables round-tripped through raw CSV.

A table is written as raw CSV with a two-row header (as the music CSVs
have) under the run folder in the shared checkpoint directory, then scanned
back as text, its header flattened, header lines dropped by content, and
cleaned by rules.  The oracle states the expected typed result directly.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators.quality import TableRules, clean_table
from ..session import ensure_checkpoint_dir
from ..sources import csv as CSV
from .common import T, rnd
from .registry import query

CUSTOMER_RULES = TableRules(
    rename={"level_0_level_1": "c_custkey", "customer_name": "c_name", "customer_nationkey": "c_nationkey"},
    standardisation={"c_custkey": ["toInt"], "c_name": ["trimSpaces", "toString"], "c_nationkey": ["toInt"],
                     "acct_balance": ["toFloat"], "segment_name": ["trimSpaces", "toUpperCase"]},
    validation={"c_custkey": ["notNull", "unique", "int"], "c_name": ["notNull", "string"],
                "c_nationkey": ["notNull", "notNegative", "int"], "acct_balance": ["notNull", "notNegative", "float"],
                "segment_name": ["notNull", "toUpperCase"]},
)


def _write_two_header_csv(spark, sf_dir, base):
    cust = T(spark, sf_dir, "customer")
    header = spark.createDataFrame([(",customer,customer,acct,segment",), (",name,nationkey,balance,name",)], "value string")
    header.coalesce(1).write.mode("overwrite").text(os.path.join(base, "header"))
    data = cust.select(F.col("c_custkey").cast("string"), F.concat(F.lit(" "), F.col("c_name")),
                       F.col("c_nationkey").cast("string"),
                       F.when(F.col("c_custkey") % 2 == 0, F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ","))
                       .otherwise(F.col("c_acctbal").cast("string")),
                       F.lower("c_mktsegment"))
    data.write.mode("overwrite").csv(os.path.join(base, "data"))


@query("csv_multiheader_scan", ("SRC-01", "SRC-02", "SRC-03", "SRC-04", "SRC-06", "SRC-07", "SRC-09", "SRC-13",
                                "PRJ-03", "JOB-04"), """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS acct_balance,
       c_mktsegment AS segment_name
FROM customer WHERE c_acctbal >= 0
""")
def csv_multiheader_scan(spark, sf_dir):
    base = os.path.join(ensure_checkpoint_dir(spark), f"csv-{uuid.uuid4().hex[:10]}")
    _write_two_header_csv(spark, sf_dir, base)
    raw = CSV.read_raw_csv(spark, os.path.join(base, "data"), header_rows=2,
                           header_path=os.path.join(base, "header"), rename=CUSTOMER_RULES.rename)
    res = clean_table(raw, CUSTOMER_RULES)
    out = os.path.join(base, "clean_customer")
    CSV.write_clean_csv(res.clean, out)
    back = spark.read.option("header", "true").csv(out)
    return back.select(F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("long"),
                       rnd(F.col("acct_balance").cast("double")).alias("acct_balance"), "segment_name")


@query("limited_scan_report", ("SRC-05",), """
SELECT count(*) AS pre_limit_rows, least(count(*), 1000) AS processed_rows FROM orders
""")
def limited_scan_report(spark, sf_dir):
    """The sampling aid: process only the first n rows, report the pre-limit count."""
    from ..sources.csv import limited
    sample, pre = limited(T(spark, sf_dir, "orders"), 1000)
    return sample.agg(F.count(F.lit(1)).alias("processed_rows")).select(
        F.lit(pre).cast("long").alias("pre_limit_rows"), "processed_rows")


@query("typed_csv_load", ("SRC-08", "SRC-06"), """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderpriority FROM orders
""")
def typed_csv_load(spark, sf_dir):
    from pyspark.sql import types as TT
    base = os.path.join(ensure_checkpoint_dir(spark), f"typed-{uuid.uuid4().hex[:10]}")
    T(spark, sf_dir, "orders").drop("o_orderdate").write.mode("overwrite").option("header", "true").csv(
        os.path.join(base, "orders"))
    schema = TT.StructType([TT.StructField("o_orderkey", TT.LongType()), TT.StructField("o_custkey", TT.LongType()),
                            TT.StructField("o_orderstatus", TT.StringType()),
                            TT.StructField("o_totalprice", TT.DoubleType()),
                            TT.StructField("o_orderpriority", TT.StringType())])
    df = CSV.read_typed_csv(spark, os.path.join(base, "orders"), schema)
    return df.withColumn("o_totalprice", rnd("o_totalprice"))


_REVENUE_SQL = """
SELECT n.n_name, count(*) AS n_lines, round(sum(l.l_extendedprice * (1 - l.l_discount)), 6) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name
"""


@query("sql_over_views", ("SRC-10",), _REVENUE_SQL)
def sql_over_views(spark, sf_dir):
    """``spark.sql`` over views registered from the tables (the SQL-text entry point)."""
    from ..sources.tables import register_views
    register_views(spark, sf_dir, ["lineitem", "orders", "customer", "nation"])
    return spark.sql(_REVENUE_SQL)


@query("first_available_source", ("SRC-11", "SRC-13"), """
SELECT p_partkey, p_name, p_size FROM part
""")
def first_available_source(spark, sf_dir):
    from ..sources.columns import require_columns
    from ..sources.io import load_first_available
    missing = os.path.join(sf_dir, "no_such_table.parquet")
    df = load_first_available([lambda: spark.read.parquet(missing),
                               lambda: T(spark, sf_dir, "part")],
                              keep=["p_partkey", "p_name", "p_size", "track_unknown_column"])
    return require_columns(df, ["p_partkey"])


@query("scoring_input_csv", ("SRC-14", "SRC-15", "REG-03"), """
SELECT o_orderkey AS track_id, CAST(o_orderdate AS DATE) AS track_date_created FROM orders
""")
def scoring_input_csv(spark, sf_dir):
    base = os.path.join(ensure_checkpoint_dir(spark), f"score-{uuid.uuid4().hex[:10]}")
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("track_id"),
                                          F.date_format("o_orderdate", "yyyy-MM-dd").alias("track_date_created"))
    o.write.mode("overwrite").option("header", "true").csv(os.path.join(base, "in"))
    df = CSV.read_scoring_input(spark, os.path.join(base, "in"))
    return df.select(F.col("track_id").cast("long"), F.to_date("track_date_created").alias("track_date_created"))
