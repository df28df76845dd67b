"""Merge-chain and projection queries on the driver tables.

Tracks = part: its genre list is text built from two nation keys (a tenth
of the parts get ``[]``), the artist is a supplier key, listens are missing
for a third of the parts and back-filled from the line-item count.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.merge import merge_job
from ..sources.columns import all_plus_derived, strip_dots
from .common import T, rnd
from .registry import query


def _tracks(spark, sf_dir):
    p = T(spark, sf_dir, "part")
    k = F.col("p_partkey")
    genres = F.when(k % 10 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("["), (k % 25).cast("string"), F.lit(", "), ((k * 7 + 3) % 25).cast("string"), F.lit("]")))
    return p.select(k.alias("track_id"), genres.alias("track_genres"), F.col("p_name").alias("track_title"),
                    (k % 100).alias("artist_id"),
                    F.when(k % 3 == 0, F.lit(None).cast("long")).otherwise(k % 50).alias("track_listens"))


@query("merge_catalog", ("JOB-06", "JOIN-02", "JOIN-03", "JOIN-04", "TOP-01", "SCL-19", "SCL-22", "SRC-12"), """
WITH t AS (
  SELECT p_partkey AS track_id, p_name AS track_title, p_partkey % 100 AS artist_id,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 50 END AS track_listens,
         CASE WHEN p_partkey % 10 = 0 THEN [NULL::BIGINT]
              WHEN p_partkey % 25 = (p_partkey * 7 + 3) % 25 THEN [p_partkey % 25, p_partkey % 25]
              ELSE [p_partkey % 25, (p_partkey * 7 + 3) % 25] END AS gl,
         CASE WHEN p_partkey % 10 = 0 THEN '[]'
              ELSE '[' || (p_partkey % 25) || ', ' || ((p_partkey * 7 + 3) % 25) || ']' END AS track_genres
  FROM part
), e AS (SELECT t.*, unnest(gl) AS genre_id FROM t),
feat AS (SELECT l_partkey AS track_id, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT e.track_id, CAST(e.genre_id AS INTEGER) AS genre_id, n.n_name AS genre_title, s.s_name AS artist_name,
       CAST(coalesce(e.track_listens, f.n_lines) AS BIGINT) AS track_listens, e.track_genres, f.n_lines
FROM e LEFT JOIN nation n ON n.n_nationkey = e.genre_id
LEFT JOIN supplier s ON s.s_suppkey = e.artist_id
LEFT JOIN feat f ON f.track_id = e.track_id
""")
def merge_catalog_query(spark, sf_dir):
    genres = T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("genre_title"))
    artists = T(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist_name"))
    feats = (T(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("track_id"))
             .agg(F.count(F.lit(1)).alias("n_lines")))
    out = merge_job(_tracks(spark, sf_dir), "track_id", "track_genres", genres, "genre_id",
                    [{"df": artists, "key": "artist_id", "suffix": "artist"},
                     {"df": feats, "key": "track_id", "suffix": "features"}],
                    fill_from=[("track_listens", "n_lines")], dry_run=True)
    return out.select("track_id", F.col("genre_id").cast("int"), "genre_title", "artist_name",
                      F.col("track_listens").cast("long"), "track_genres", "n_lines")


@query("wide_features_dotless", ("PRJ-05", "AGG-13", "LOAD-07"), """
SELECT l_orderkey,
       round(sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END), 6) AS qty1,
       round(sum(CASE WHEN l_linenumber = 2 THEN l_quantity ELSE 0 END), 6) AS qty2,
       round(sum(CASE WHEN l_linenumber = 3 THEN l_quantity ELSE 0 END), 6) AS qty3,
       round(sum(CASE WHEN l_linenumber = 4 THEN l_quantity ELSE 0 END), 6) AS qty4,
       round(sum(CASE WHEN l_linenumber = 5 THEN l_quantity ELSE 0 END), 6) AS qty5,
       round(sum(CASE WHEN l_linenumber = 6 THEN l_quantity ELSE 0 END), 6) AS qty6,
       round(sum(CASE WHEN l_linenumber = 7 THEN l_quantity ELSE 0 END), 6) AS qty7,
       round(sum(CASE WHEN l_linenumber NOT BETWEEN 1 AND 7 THEN l_quantity ELSE 0 END), 6) AS qtyrest
FROM lineitem GROUP BY l_orderkey
""")
def wide_features_dotless(spark, sf_dir):
    """Every line in a column of its slot; a line number beyond the seven slots goes to the last column."""
    slot = F.when(F.col("l_linenumber").between(1, 7), F.col("l_linenumber").cast("string")).otherwise("rest")
    li = T(spark, sf_dir, "lineitem").withColumn("slot", F.concat(F.lit("qty."), slot))
    slots = [f"qty.{i}" for i in (*range(1, 8), "rest")]
    flat = strip_dots(li.groupBy("l_orderkey").pivot("slot", slots).agg(F.sum("l_quantity")).fillna(0))
    return flat.select("l_orderkey", *[rnd(c).alias(c) for c in flat.columns if c != "l_orderkey"])


@query("all_plus_derived", ("PRJ-04", "JOIN-05"), """
SELECT p.*, d.n_lines, round(d.avg_qty, 6) AS avg_qty
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS n_lines, avg(l_quantity) AS avg_qty FROM lineitem GROUP BY 1) d
  ON d.l_partkey = p.p_partkey
""")
def all_plus_derived_query(spark, sf_dir):
    part = T(spark, sf_dir, "part")
    derived = (T(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
               .agg(F.count(F.lit(1)).alias("n_lines"), F.avg("l_quantity").alias("avg_qty"))
               .withColumn("p_name", F.lit("shadowed")))           # a duplicate column is dropped
    out = all_plus_derived(part, derived, "p_partkey")
    return out.withColumn("avg_qty", rnd("avg_qty"))
