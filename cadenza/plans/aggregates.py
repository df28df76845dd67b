"""Generic aggregate / window / top-k / set queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import charts as C
from ..operators import joins as J
from .common import T, rnd
from .registry import query


@query("avg_by_label", ("CH-02", "AGG-01", "FIL-01"), """
SELECT p_type, round(avg(p_size), 6) AS mean_value FROM part
WHERE p_type IS NOT NULL AND p_size IS NOT NULL GROUP BY p_type
""")
def avg_by_label(spark, sf_dir):
    out = A.mean_by_group(T(spark, sf_dir, "part"), "p_type", "p_size")
    return out.select("p_type", rnd("mean_value").alias("mean_value"))


@query("sum_by_label", ("AGG-02", "CH-05"), """
SELECT o_orderpriority, round(sum(o_totalprice), 6) AS total FROM orders
WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY o_orderpriority
""")
def sum_by_label(spark, sf_dir):
    out = A.sum_by_group(T(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return out.select("o_orderpriority", rnd("total").alias("total"))


@query("radar_means", ("CH-06", "AGG-10", "FIL-02"), """
SELECT p_type, round(avg(p_size), 6) AS avg_p_size, round(avg(p_retailprice), 6) AS avg_p_retailprice,
       count(*) AS n_rows
FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') AND p_size IS NOT NULL AND p_retailprice IS NOT NULL
GROUP BY p_type
""")
def radar_means(spark, sf_dir):
    out = C.radar_means(T(spark, sf_dir, "part"), "p_type", ["p_size", "p_retailprice"],
                        ["ECONOMY", "PROMO", "SMALL"])
    return out.select("p_type", rnd("avg_p_size").alias("avg_p_size"),
                      rnd("avg_p_retailprice").alias("avg_p_retailprice"), "n_rows")


_TOPN_SQL = """
WITH totals AS (
  SELECT {label} AS label, {measure} AS total FROM {table}
  WHERE {label} IS NOT NULL {value_filter} GROUP BY {label}
), top AS (SELECT label FROM totals ORDER BY total DESC, label ASC LIMIT {n}),
rolled AS (
  SELECT CASE WHEN label IN (SELECT label FROM top) THEN label ELSE 'Others' END AS {label}, sum(total) AS total
  FROM totals GROUP BY 1
)
SELECT {label}, {total_expr} AS total,
       round(100.0 * total / nullif((SELECT sum(total) FROM totals), 0), 6) AS share
FROM rolled
"""


@query("top_n_with_others_sum", ("AGG-03", "AGG-04", "SET-05", "TOP-08"),
       _TOPN_SQL.format(label="o_orderpriority", measure="sum(o_totalprice)", table="orders",
                        value_filter="AND o_totalprice IS NOT NULL", n=3, total_expr="round(total, 6)"))
def top_n_with_others_sum(spark, sf_dir):
    out = A.top_n_with_others(T(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", 3)
    return out.select("o_orderpriority", rnd("total").alias("total"), rnd("share").alias("share"))


@query("top_n_with_others_count", ("AGG-03", "AGG-04", "AGG-07", "CH-05"),
       _TOPN_SQL.format(label="n_name", measure="count(*)",
                        table="(SELECT n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)",
                        value_filter="", n=10, total_expr="CAST(total AS BIGINT)"))
def top_n_with_others_count(spark, sf_dir):
    cust = T(spark, sf_dir, "customer").join(
        T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    out = A.top_n_with_others(cust, "n_name", None, 10)
    return out.select("n_name", F.col("total").cast("long").alias("total"), rnd("share").alias("share"))


@query("value_shares", ("AGG-05", "CH-03", "WIN-06"), """
SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS proportion
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def value_shares(spark, sf_dir):
    out = A.value_shares(T(spark, sf_dir, "events"), "event_type")
    return out.select("event_type", "n", rnd("proportion").alias("proportion"))


@query("label_proportions", ("AGG-05", "AGG-07"), """
SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS proportion
FROM labels WHERE quality IS NOT NULL GROUP BY quality
""")
def label_proportions(spark, sf_dir):
    out = A.value_shares(T(spark, sf_dir, "labels"), "quality")
    return out.select("quality", "n", rnd("proportion").alias("proportion"))


@query("exploded_label_counts", ("AGG-06", "SCL-15"), """
SELECT w AS value, count(*) AS count FROM (
  SELECT unnest(list_filter(list_transform(regexp_split_to_array(p_name, '[,/ ]'), lambda x: trim(x)), lambda x: x <> '')) AS w
  FROM part
) GROUP BY w
""")
def exploded_label_counts(spark, sf_dir):
    from ..functions.standardise import survey_to_array
    part = T(spark, sf_dir, "part").select(survey_to_array(F.col("p_name"), r"[,/ ]").alias("words"))
    return A.exploded_value_counts(part, "words")


@query("value_counts_segment", ("AGG-07",), """
SELECT c_mktsegment, count(*) AS count FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment
""")
def value_counts_segment(spark, sf_dir):
    return A.value_counts(T(spark, sf_dir, "customer"), "c_mktsegment")


@query("group_profile", ("CH-04", "AGG-08"), """
SELECT l_orderkey, round(avg(l_quantity), 6) AS avg_l_quantity, round(avg(l_discount), 6) AS avg_l_discount,
       round(avg(l_tax), 6) AS avg_l_tax, count(l_partkey) AS n_rows
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL
  AND l_tax IS NOT NULL AND l_partkey IS NOT NULL
GROUP BY l_orderkey
""")
def group_profile(spark, sf_dir):
    groups = C.album_bubbles(T(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", "l_discount",
                             "l_tax", "l_partkey")
    return groups.select("l_orderkey", *[rnd(c).alias(c) for c in ("avg_l_quantity", "avg_l_discount", "avg_l_tax")],
                         "n_rows")


@query("group_profile_quantiles", ("CH-04", "AGG-09"), """
WITH g AS (
  SELECT l_orderkey, count(l_partkey) AS n_rows FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL
    AND l_tax IS NOT NULL AND l_partkey IS NOT NULL GROUP BY l_orderkey
)
SELECT round(quantile_cont(n_rows, 0.25), 6) AS q25, round(quantile_cont(n_rows, 0.5), 6) AS q50,
       round(quantile_cont(n_rows, 0.75), 6) AS q75 FROM g
""")
def group_profile_quantiles(spark, sf_dir):
    q = C.bubble_sizes(C.album_bubbles(T(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", "l_discount",
                                       "l_tax", "l_partkey"))
    return q.select(*[rnd(c).alias(c) for c in ("q25", "q50", "q75")])


@query("binned_counts_top_keys", ("CH-01", "AGG-11", "TOP-03", "AGG-27", "AGG-12", "SCL-28"), """
WITH li AS (
  SELECT l.l_suppkey, l.l_partkey, CAST(l.l_extendedprice AS DOUBLE) AS v, coalesce(s.s_acctbal, 0.0) AS rk
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE l.l_extendedprice IS NOT NULL
), ranks AS (SELECT l_suppkey, max(rk) AS best FROM li WHERE l_suppkey IS NOT NULL GROUP BY 1),
top AS (SELECT l_suppkey FROM ranks ORDER BY best DESC, l_suppkey LIMIT 9),
work AS (SELECT DISTINCT l_suppkey, l_partkey, v FROM li WHERE l_suppkey IN (SELECT l_suppkey FROM top)),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM work),
edges AS (
  SELECT k, CASE WHEN k = 0 THEN lo - (hi - lo) * 0.001 WHEN k = 12 THEN hi ELSE k * ((hi - lo) / 12) + lo END AS e
  FROM st, range(0, 13) t(k)
), labelled AS (SELECT k, round(e, 3) AS le FROM edges),
mids AS (SELECT a.k + 1 AS bin, (a.le + b.le) / 2 AS x FROM labelled a JOIN labelled b ON b.k = a.k + 1),
binned AS (
  SELECT w.l_suppkey, coalesce((SELECT min(k) FROM edges WHERE k BETWEEN 1 AND 11 AND w.v <= e), 12) AS bin FROM work w
), counts AS (SELECT l_suppkey, bin, count(*) AS n FROM binned GROUP BY 1, 2),
grid AS (SELECT DISTINCT w.l_suppkey, m.bin, m.x FROM work w, mids m)
SELECT g.l_suppkey, coalesce(s.s_name, 'Artist ' || g.l_suppkey) AS name, CAST(g.bin AS INTEGER) AS bin,
       round(g.x, 6) AS x, coalesce(c.n, 0) AS count
FROM grid g LEFT JOIN counts c ON c.l_suppkey = g.l_suppkey AND c.bin = g.bin
LEFT JOIN supplier s ON s.s_suppkey = g.l_suppkey
""")
def binned_counts_top_keys(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice")
    sup = T(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal", "s_name")
    facts = J.priority_merge(li, sup, "l_suppkey")
    out = C.binned_counts_top_keys(facts, "l_suppkey", "l_partkey", "l_extendedprice", "s_acctbal",
                                   top_n=9, bins=12, name_col="s_name")
    return out.select("l_suppkey", "name", "bin", rnd("x").alias("x"), "count")


@query("max_by_key_top", ("AGG-11", "TOP-03"), """
SELECT s_nationkey, round(max(s_acctbal), 6) AS max_value FROM supplier
GROUP BY s_nationkey ORDER BY max(s_acctbal) DESC, s_nationkey LIMIT 5
""")
def max_by_key_top(spark, sf_dir):
    m = A.max_by_key(T(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal")
    return m.orderBy(F.desc("max_value"), "s_nationkey").limit(5).select("s_nationkey", rnd("max_value").alias("max_value"))


@query("mean_by_position", ("CH-07", "WIN-02", "AGG-29", "FIL-04"), """
WITH r AS (
  SELECT l_linenumber, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_partkey, l_suppkey,
                            l_extendedprice, l_shipdate) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL
)
SELECT l_linenumber, round(avg(l_quantity), 6) AS avg_l_quantity FROM r WHERE rn <= 3 AND l_linenumber <= 5
GROUP BY l_linenumber
""")
def mean_by_position(spark, sf_dir):
    out = A.mean_by_position(T(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity",
                             first_n=3, max_position=5,
                             tie_cols=("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    return out.select("l_linenumber", rnd("avg_l_quantity").alias("avg_l_quantity"))


_LOO_VARS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _loo_sql():
    v = _LOO_VARS
    means = ", ".join(f"(sum({c}) OVER w - {c}) / (count(*) OVER w - 1) AS {c}_loo" for c in v)
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS row_var, '{b}' AS col_var, round(corr({a}, {b}_loo), 6) AS r FROM m"
        for a in v for b in v)
    return f"""
WITH f AS (
  SELECT * FROM lineitem WHERE l_orderkey IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in v)}
), k AS (SELECT l_orderkey FROM f GROUP BY l_orderkey HAVING count(*) >= 2),
m AS (
  SELECT {', '.join(v)}, {means} FROM f WHERE l_orderkey IN (SELECT l_orderkey FROM k)
  WINDOW w AS (PARTITION BY l_orderkey)
)
{pairs}
"""


@query("leave_one_out_corr", ("STAT-11", "AGG-18", "AGG-19", "WIN-04", "FIL-06"), _loo_sql())
def leave_one_out_corr(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", *_LOO_VARS)
    loo = A.leave_one_out_means(li, "l_orderkey", list(_LOO_VARS))
    out = A.correlation_long(loo, list(_LOO_VARS), [f"{c}_loo" for c in _LOO_VARS])
    return out.select("row_var", F.regexp_replace("col_var", "_loo$", "").alias("col_var"), rnd("r").alias("r"))


@query("pivot_sum", ("AGG-13",), """
SELECT l_returnflag, round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END), 6) AS F,
       round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 6) AS O
FROM lineitem GROUP BY l_returnflag
""")
def pivot_sum(spark, sf_dir):
    p = A.pivot_sum(T(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", ["F", "O"])
    return p.select("l_returnflag", rnd("F").alias("F"), rnd("O").alias("O"))


@query("crosstab_counts", ("AGG-17",), """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2
""")
def crosstab_counts(spark, sf_dir):
    return A.crosstab_long(T(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("distinct_text_agg", ("AGG-21",), """
SELECT p_type, array_to_string(list_sort(list_distinct(list(p_brand))), ' ') AS brands FROM part GROUP BY p_type
""")
def distinct_text_agg(spark, sf_dir):
    return A.distinct_text(T(spark, sf_dir, "part"), "p_type", "p_brand", "brands")


@query("duplicate_flags", ("AGG-28", "VAL-10"), """
SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) > 1 AS is_duplicate FROM orders
""")
def duplicate_flags(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return A.duplicate_flag(o, "o_custkey").select("o_orderkey", "is_duplicate")


@query("latest_per_key", ("JOIN-08", "VIEW-05"), """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(round(value, 6), (ts, event_id)) AS value,
       max(ts) AS ts
FROM events GROUP BY user_id
""")
def latest_per_key(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    out = J.latest_per_key(ev, "user_id", "ts", ["event_type", "value", "ts"], tie_cols=["event_id"])
    return out.select("user_id", "event_type", rnd("value").alias("value"), "ts")


@query("latest_per_key_rn", ("JOIN-09", "WIN-01"), """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
""")
def latest_per_key_rn(spark, sf_dir):
    ev = T(spark, sf_dir, "events")
    return J.latest_per_key_rn(ev, "user_id", "ts", tie_cols=["event_id"]).select("user_id", "event_id", "event_type")


@query("conversation_turn_means", ("AGG-29", "AGG-22"), """
SELECT turn, round(avg(length(text)), 6) AS avg_len, count(*) AS n FROM conversations GROUP BY turn
""")
def conversation_turn_means(spark, sf_dir):
    c = T(spark, sf_dir, "conversations")
    return c.groupBy("turn").agg(rnd(F.avg(F.length("text"))).alias("avg_len"), F.count(F.lit(1)).alias("n"))


@query("conversation_roles_ordered", ("AGG-22", "JOIN-13"), """
SELECT conv_id, array_to_string(list(role ORDER BY turn), '>') AS roles, count(*) AS n_turns
FROM conversations GROUP BY conv_id
""")
def conversation_roles_ordered(spark, sf_dir):
    c = T(spark, sf_dir, "conversations")
    agg = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("s"),
                                   F.count(F.lit(1)).alias("n_turns"))
    return agg.select("conv_id", F.array_join(F.transform("s", lambda x: x["role"]), ">").alias("roles"), "n_turns")


# Seeded listener titles (matched case-insensitively).
SEED_TITLES = ["SMALL RING", "Red Widget", "blue bolt", "Hot Gear", "small gizmo"]


@query("title_lookup_first", ("FIL-08", "FIL-09"), """
SELECT t.title, p.p_partkey FROM (SELECT unnest(['SMALL RING', 'Red Widget', 'blue bolt', 'Hot Gear', 'small gizmo']) AS title) t
JOIN (
  SELECT p_partkey, p_name, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS rn FROM part
) p ON lower(p.p_name) = lower(t.title) AND p.rn = 1
""")
def title_lookup_first(spark, sf_dir):
    """First catalogue row whose title matches each seed title, case-insensitively."""
    part = T(spark, sf_dir, "part").select("p_partkey", "p_name")
    titles = spark.createDataFrame([(t,) for t in SEED_TITLES], "title string")
    hits = J.ci_equi_join(titles, part, "title", "p_name")
    return A.first_n_per_group(hits, "title", [F.col("p_partkey")], 1).select("title", "p_partkey")
