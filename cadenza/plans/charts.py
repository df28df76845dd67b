"""Chart-data queries (CH-*) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import charts as C
from .common import T, merged_facts, rnd
from .registry import query

_JUNK = "('', 'nan', 'none', 'null', 'unknown', 'n/a', 'na')"

_POP_BASE = f"""
WITH base AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, trim(CAST(p.p_type AS VARCHAR)) AS p_type,
         TRY_CAST(l.l_quantity AS DOUBLE) AS m
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  WHERE p.p_type IS NOT NULL AND lower(trim(p.p_type)) NOT IN {_JUNK}
    AND o.o_orderdate IS NOT NULL AND l.l_quantity IS NOT NULL
), top AS (
  SELECT p_type FROM base GROUP BY p_type ORDER BY {{score}} DESC, p_type ASC LIMIT {{top}}
), dff AS (
  SELECT * FROM base WHERE p_type IN (SELECT p_type FROM top)
), valid AS (
  SELECT year FROM dff GROUP BY year HAVING count(*) >= {{min_rows}}
), grid AS (
  SELECT v.year, t.p_type FROM valid v, top t
), cells AS ({{cells}})
SELECT g.year, g.p_type,
       round(avg(c.v) OVER (PARTITION BY g.p_type ORDER BY g.year ROWS BETWEEN {{prev}} PRECEDING AND CURRENT ROW), 6) AS value
FROM grid g LEFT JOIN cells c ON g.year = c.year AND g.p_type = c.p_type
"""


def _pop_sql(cells: str, score: str = "sum(m)", top: int = 4, min_rows: int = 200, window: int = 3) -> str:
    return _POP_BASE.format(score=score, top=top, min_rows=min_rows, prev=window - 1, cells=cells)


def _pop(spark, sf_dir, agg, top=4, top_by="sum_metric", log=False):
    facts = merged_facts(spark, sf_dir, li_cols=("l_quantity",))
    out = C.popularity_by_year(facts, "p_type", "o_orderdate", "l_quantity", agg=agg, top=top,
                               top_by=top_by, min_year_count=200, smooth_window=3, log=log)
    return out.select("year", "p_type", rnd("value").alias("value"))


@query("popularity_by_label_year_median", ("CH-08", "JOIN-01", "FIL-03", "TOP-02", "AGG-14", "FIL-05", "WIN-03", "SET-03"),
       _pop_sql("SELECT year, p_type, median(m) AS v FROM dff GROUP BY 1, 2"))
def popularity_median(spark, sf_dir):
    return _pop(spark, sf_dir, "median")


@query("popularity_by_label_year_mean", ("CH-08", "AGG-15", "WIN-03"),
       _pop_sql("SELECT year, p_type, avg(m) AS v FROM dff GROUP BY 1, 2"))
def popularity_mean(spark, sf_dir):
    return _pop(spark, sf_dir, "mean")


@query("popularity_by_label_year_share", ("CH-08", "AGG-16", "WIN-03"),
       _pop_sql("SELECT year, p_type, 100.0 * sum(m) / nullif(sum(sum(m)) OVER (PARTITION BY year), 0) AS v "
                "FROM dff GROUP BY 1, 2"))
def popularity_share(spark, sf_dir):
    return _pop(spark, sf_dir, "share")


@query("popularity_by_label_year_count_log", ("CH-08", "TOP-02", "SCL-26"),
       _pop_sql("SELECT year, p_type, median(ln(1 + greatest(m, 0.0))) AS v FROM dff GROUP BY 1, 2",
                score="count(*)", top=3))
def popularity_count_log(spark, sf_dir):
    return _pop(spark, sf_dir, "median", top=3, top_by="count", log=True)
