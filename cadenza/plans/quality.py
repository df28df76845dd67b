"""Data-quality queries (JOB-01 … JOB-03, SCL-*, VAL-*) on the driver tables.

The driver tables hold no dirty text, so defects are injected by
deterministic expressions of the keys.  The oracle SQL does not re-implement
the parsers: it states the expected value from the ORIGINAL column and the
injection rule (parse(format(x)) = x), which makes it an independent check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardise as S
from ..operators.quality import TableRules, clean_table
from .common import T, rnd
from .registry import query

EVENT_RULES = TableRules(
    standardisation={"event_id": ["toInt"], "ts": ["parseDate"], "user_id": ["toInt"],
                     "event_type": ["trimSpaces", "toLowerCase"], "value": ["toFloat"]},
    validation={"event_id": ["notNull", "unique", "notNegative", "int"],
                "ts": ["notNull", "beforeNow", "date"],
                "user_id": ["notNull", "int"],
                "event_type": ["notNull", "string", "toLowerCase"],
                "value": ["notNull", "notNegative", "float"]},
)


def dirty_events(spark, sf_dir):
    """Events as raw text with injected defects (all driven by event_id)."""
    return inject_event_defects(T(spark, sf_dir, "events"))


def inject_event_defects(e):
    """Works on a batch or a streaming frame of events."""
    eid = F.col("event_id")
    raw_id = (F.when(eid % 97 == 5, F.concat(F.lit("x"), eid.cast("string")))
              .when(eid % 113 == 7, (eid - 1).cast("string"))
              .when(eid % 10 == 3, F.concat(F.lit(" "), eid.cast("string"), F.lit(" ")))
              .otherwise(eid.cast("string")))
    raw_ts = (F.when(eid % 89 == 1, F.lit("not a date"))
              .when(eid % 5 == 0, F.date_format("ts", "yyyy/MM/dd"))
              .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    raw_type = F.when(eid % 4 == 0, F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))).otherwise(F.col("event_type"))
    raw_value = (F.when(eid % 71 == 3, F.concat(F.lit("-"), F.col("value").cast("string")))
                 .when(eid % 3 == 0, F.regexp_replace(F.col("value").cast("string"), r"\.", ","))
                 .otherwise(F.col("value").cast("string")))
    return e.select(raw_id.alias("event_id"), raw_ts.alias("ts"), F.col("user_id").cast("string").alias("user_id"),
                    raw_type.alias("event_type"), raw_value.alias("value"), "props")


_EXPECTED = """
WITH p AS (
  SELECT CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 113 = 7 THEN event_id - 1 ELSE event_id END AS eid,
         CASE WHEN event_id % 89 = 1 THEN NULL ELSE CAST(ts AS DATE) END AS d,
         user_id, event_type,
         CASE WHEN event_id % 71 = 3 THEN -value ELSE value END AS v
  FROM events
), f AS (
  SELECT *, CASE
      WHEN eid IS NULL THEN 'event_id:notNull'
      WHEN count(*) OVER (PARTITION BY eid) > 1 THEN 'event_id:unique'
      WHEN d IS NULL THEN 'ts:notNull'
      WHEN v < 0 THEN 'value:notNegative'
    END AS first_failure
  FROM p
)
"""


@query("clean_events", ("JOB-01", "JOB-02", "FIL-07", "VAL-12", "SCL-04", "SCL-05", "SCL-08", "SCL-01", "SCL-02",
                        "SCL-20", "VAL-01", "VAL-02", "VAL-04", "VAL-05", "VAL-06", "VAL-07", "VAL-08",
                        "VAL-10", "PRJ-01", "UDF-01", "UDF-02"),
       _EXPECTED + """
SELECT eid AS event_id, d AS ts, user_id, event_type, round(v, 6) AS value FROM f WHERE first_failure IS NULL
""")
def clean_events(spark, sf_dir):
    res = clean_table(dirty_events(spark, sf_dir), EVENT_RULES, as_of="2030-01-01 00:00:00")
    return res.clean.select("event_id", "ts", "user_id", "event_type", rnd("value").alias("value"))


@query("clean_failures", ("AGG-31", "JOB-02", "SRC-18"), _EXPECTED + """
SELECT first_failure, count(*) AS failures FROM f WHERE first_failure IS NOT NULL GROUP BY 1
""")
def clean_failures(spark, sf_dir):
    return clean_table(dirty_events(spark, sf_dir), EVENT_RULES, as_of="2030-01-01 00:00:00").failures()


@query("clean_report", ("JOB-03", "SRC-18"), _EXPECTED + """
SELECT count(*) AS filtered_rows, count(*) FILTER (WHERE first_failure IS NULL) AS cleaned_rows,
       count(*) FILTER (WHERE first_failure IS NOT NULL) AS removed_rows,
       round(100.0 * count(*) FILTER (WHERE first_failure IS NULL) / count(*), 6) AS retention_pct
FROM f
""")
def clean_report(spark, sf_dir):
    r = clean_table(dirty_events(spark, sf_dir), EVENT_RULES, as_of="2030-01-01 00:00:00").report()
    return r.select("filtered_rows", "cleaned_rows", "removed_rows", rnd("retention_pct").alias("retention_pct"))


@query("duplicate_rejects", ("VAL-10", "AGG-28"), _EXPECTED + """
SELECT eid AS event_id, count(*) AS copies FROM f WHERE first_failure = 'event_id:unique' GROUP BY eid
""")
def duplicate_rejects(spark, sf_dir):
    res = clean_table(dirty_events(spark, sf_dir), EVENT_RULES, as_of="2030-01-01 00:00:00")
    return res.rejected("event_id:unique").groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


@query("parse_numbers", ("SCL-04", "SCL-05", "SCL-21", "SCL-28"), """
SELECT c_custkey,
       CASE c_custkey % 5
         WHEN 4 THEN CASE WHEN c_acctbal = trunc(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR)
                          ELSE replace(CAST(c_acctbal AS VARCHAR), '.', ',') END
         ELSE CAST(c_custkey * 1000 + 7 AS VARCHAR) END AS int_text,
       round(c_acctbal, 6) AS float_value
FROM customer
""")
def parse_numbers(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    big = k * 1000 + 7
    int_raw = (F.when(k % 5 == 0, F.concat(F.lit(" "), big.cast("string"), F.lit(" ")))
               .when(k % 5 == 1, F.format_number(big, 0))
               .when(k % 5 == 2, F.concat(big.cast("string"), F.lit(".0")))
               .when(k % 5 == 3, F.concat(F.lit("+"), F.regexp_replace(F.format_number(big, 0), ",", " ")))
               .otherwise(F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ",")))
    acct = F.col("c_acctbal")
    float_raw = (F.when(k % 4 == 0, acct.cast("string"))
                 .when(k % 4 == 1, F.regexp_replace(acct.cast("string"), r"\.", ","))
                 .when(k % 4 == 2, F.format_number(acct, 2))
                 .otherwise(F.concat(F.lit(" "), acct.cast("string"), F.lit(" "))))
    return c.select("c_custkey", S.to_int(int_raw).alias("int_text"),
                    rnd(S.to_float(float_raw).try_cast("double")).alias("float_value"))


@query("parse_durations", ("SCL-10",), """
SELECT o_orderkey,
       CASE o_orderkey % 5
         WHEN 3 THEN CASE WHEN (o_orderkey % 7200) % 60 = 0 THEN '1:75' ELSE CAST(o_orderkey % 7200 AS VARCHAR) END
         WHEN 4 THEN 'abc'
         ELSE CAST(o_orderkey % 7200 AS VARCHAR) END AS seconds
FROM orders
""")
def parse_durations(spark, sf_dir):
    o = T(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = k % 7200
    h, m, s = F.floor(d / 3600), F.floor((d % 3600) / 60), d % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    raw = (F.when(k % 5 == 0, F.concat_ws(":", two(h), two(m), two(s)))
           .when(k % 5 == 1, F.concat_ws(":", (h * 60 + m).cast("string"), two(s)))
           .when(k % 5 == 2, F.concat(d.cast("string"), F.lit(".9")))
           .when(k % 5 == 3, F.when(s == 0, F.lit("1:75")).otherwise(d.cast("string")))
           .otherwise(F.lit("abc")))
    return o.select("o_orderkey", S.normalize_duration(raw).alias("seconds"))


@query("parse_list_variants", ("SCL-11", "SCL-12", "SCL-13", "SCL-14", "SCL-18", "SCL-19", "SCL-22",
                               "UDF-03", "UDF-05"), """
SELECT p_partkey,
       CASE p_partkey % 4
         WHEN 0 THEN '[' || p_partkey || ', ' || (p_partkey + 1) || ']'
         WHEN 1 THEN '[' || p_partkey || ']'
         WHEN 2 THEN '[' || p_partkey || ']'
         ELSE '[]' END AS genre_ids,
       CASE p_partkey % 4
         WHEN 0 THEN '["' || p_brand || '","' || p_type || '"]'
         WHEN 1 THEN '["' || p_brand || '"]'
         WHEN 2 THEN '["' || p_type || '"]'
         ELSE '[]' END AS tags,
       CASE p_partkey % 4
         WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END AS n_items
FROM part
""")
def parse_list_variants(spark, sf_dir):
    p = T(spark, sf_dir, "part")
    k = F.col("p_partkey")
    ks, k1 = k.cast("string"), (k + 1).cast("string")
    genre_raw = (F.when(k % 4 == 0, F.concat(F.lit("["), ks, F.lit(", "), k1, F.lit("]")))
                 .when(k % 4 == 1, F.concat(F.lit("[{'genre_id': '"), ks, F.lit("'}]")))
                 .when(k % 4 == 2, F.concat(F.lit("['"), ks, F.lit("', 'x']")))
                 .otherwise(F.lit("")))
    tag_raw = (F.when(k % 4 == 0, F.concat(F.lit("[' "), F.col("p_brand"), F.lit(" ', '', \""), F.col("p_type"), F.lit("\"]")))
               .when(k % 4 == 1, F.concat(F.lit("[{'name': '"), F.col("p_brand"), F.lit("'}]")))
               .when(k % 4 == 2, F.concat(F.lit("[{'tag': '"), F.col("p_type"), F.lit("', 'other': None}]")))
               .otherwise(F.lit("a,b")))
    list_raw = (F.when(k % 4 == 0, F.concat(F.lit("['"), ks, F.lit("', '"), k1, F.lit("']")))
                .when(k % 4 == 1, F.concat(F.lit("["), ks, F.lit("]")))
                .when(k % 4 == 2, F.concat(F.lit("[\""), ks, F.lit("\"]")))
                .otherwise(F.lit("[]")))
    return p.select("p_partkey", S.json_list_text(S.extract_genre_ids(genre_raw)).alias("genre_ids"),
                    F.to_json(S.normalize_tags(tag_raw)).alias("tags"),
                    F.size(S.parse_python_list(list_raw)).alias("n_items"))


WIDE_RULES = TableRules(standardisation={"l_orderkey": ["toInt"], "__all__": ["toFloat"]},
                        validation={"l_orderkey": ["notNull", "int"], "__all__": ["notNull", "float"]})


@query("clean_all_default", ("PRJ-02", "PRJ-01", "JOB-04"), """
SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, round(l_quantity, 6) AS l_quantity,
       round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax
FROM lineitem WHERE l_orderkey % 13 <> 0
""")
def clean_all_default(spark, sf_dir):
    """A wide numeric table cleaned by one ``__all__`` rule (the features preset's shape)."""
    li = T(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                    F.col("l_linenumber").cast("string").alias("l_linenumber"),
                    F.col("l_quantity").cast("string").alias("l_quantity"),
                    F.regexp_replace(F.col("l_discount").cast("string"), r"\.", ",").alias("l_discount"),
                    F.when(F.col("l_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.col("l_tax").cast("string"))
                    .alias("l_tax"))
    res = clean_table(raw, WIDE_RULES)
    return res.clean.select("l_orderkey", "l_linenumber", *[rnd(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])
