"""Regression queries (REG-*) on the driver tables.

Track = part; target ("listens") = total quantity over its line items;
features: p_size, p_retailprice, age in years of its first order (as of
2002-01-01) and the latest line item's discount and tax (``rn = 1`` by ship
date); the fitted model also takes that line's quantity and price, the number
of lines and the highest order total (nine numerics).  Nulls are injected into p_retailprice (p_partkey % 11 = 0).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.standardise import age_years
from ..operators import regress as G
from ..session import cut_lineage
from .common import T, rnd
from .registry import query

FEATURES = ["p_size", "p_retailprice", "age_years", "l_discount", "l_tax"]
NINE = [*FEATURES, "l_quantity", "l_extendedprice", "n_lines", "max_total"]
AS_OF = "2002-01-01 00:00:00"


def _frame(spark, sf_dir, latest=("l_discount", "l_tax")):
    """The feature frame, written once: medians, moments, split, fit and scoring all read the table."""
    part = T(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    li = T(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    o = T(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_totalprice")
    first = (li.join(o, "l_orderkey").groupBy("p_partkey")
             .agg(F.sum("l_quantity").alias("listens"), F.min("o_orderdate").alias("first_date"),
                  F.count("*").cast("double").alias("n_lines"), F.max("o_totalprice").alias("max_total")))
    base = part.join(first, "p_partkey", "left").withColumn("age_years", age_years(F.col("first_date"), AS_OF))
    return cut_lineage(G.latest_rank_frame(base, "p_partkey", li, "l_shipdate", list(latest),
                                           tie_cols=["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]), "regression-frame")


def _prep_sql(feats=FEATURES, digits=6, heard_only=False):
    def rounded(x):
        return f"round({x}, {digits})" if digits else x
    fill = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM f)) AS {c}" for c in feats)
    z = ", ".join(rounded(f"coalesce(({c} - (SELECT avg({c}) FROM g)) / (CASE WHEN (SELECT stddev_samp({c}) FROM g) IS NULL "
                          f"OR (SELECT stddev_samp({c}) FROM g) = 0 THEN 1.0 ELSE (SELECT stddev_samp({c}) FROM g) END), 0.0)") + f" AS {c}"
                  for c in feats)
    keys = "(l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)"
    latest = ", ".join(f"arg_max({c}, {keys}) AS {c}" for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice"))
    return f"""
WITH li AS (SELECT * FROM lineitem),
first AS (
  SELECT l.l_partkey AS p_partkey, sum(l.l_quantity) AS listens, min(o.o_orderdate) AS first_date,
         CAST(count(*) AS DOUBLE) AS n_lines, max(o.o_totalprice) AS max_total
  FROM li l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1
), latest AS (
  SELECT l_partkey AS p_partkey, {latest} FROM li GROUP BY 1
), f AS (
  SELECT p.p_partkey, CAST(p.p_size AS DOUBLE) AS p_size,
         CASE WHEN p.p_partkey % 11 = 0 THEN NULL ELSE p.p_retailprice END AS p_retailprice,
         (epoch(TIMESTAMP '{AS_OF}') - epoch(fi.first_date)) / 86400.0 / 365.25 AS age_years,
         lt.l_discount, lt.l_tax, lt.l_quantity, lt.l_extendedprice, fi.n_lines, fi.max_total, fi.listens
  FROM part p LEFT JOIN first fi ON fi.p_partkey = p.p_partkey LEFT JOIN latest lt ON lt.p_partkey = p.p_partkey
  {"WHERE fi.listens IS NOT NULL" if heard_only else ""}
), g AS (SELECT p_partkey, {fill}, listens FROM f)
SELECT p_partkey, {z}, {rounded("coalesce(ln(1 + greatest(listens, 0.0)), 0.0)")} AS label FROM g
"""


@query("regression_features", ("REG-01", "REG-02", "REG-03", "JOIN-09", "SCL-25", "SCL-26", "AGG-32"), _prep_sql())
def regression_features(spark, sf_dir):
    frame = _frame(spark, sf_dir)
    meta = G.fit_prep(frame, FEATURES)
    out = G.apply_prep(frame, meta, keep=["p_partkey"], target="listens")
    return out.select("p_partkey", *[rnd(c).alias(c) for c in FEATURES], rnd("label").alias("label"))


def _heard(spark, sf_dir):
    return _frame(spark, sf_dir, ["l_discount", "l_tax", "l_quantity", "l_extendedprice"]).filter(F.col("listens").isNotNull())


#: A model whose coefficients are given: its metrics can be repeated by any engine.
FIXED = G.LinearFit(NINE, [0.01, -0.02, 0.15, 0.005, -0.01, 0.03, 0.02, 0.4, 0.05], 6.5)


def _fixed_sql():
    cut = _prep_sql(NINE, digits=0, heard_only=True).rindex("SELECT p_partkey")
    base = _prep_sql(NINE, digits=0, heard_only=True)
    linear = " + ".join(f"{c} * {f}" for f, c in zip(FIXED.features, FIXED.coefficients))
    return f"""{base[:cut].rstrip()}, z AS ({base[cut:]}),
p AS (SELECT label, least(greatest({FIXED.intercept} + {linear}, (SELECT min(label) FROM z)), (SELECT max(label) FROM z)) AS pred FROM z),
both_scales AS (
  SELECT 'log' AS scale, label AS y, pred AS p FROM p
  UNION ALL SELECT 'natural', exp(label) - 1, exp(pred) - 1 FROM p)
SELECT scale, round(sqrt(avg((y - p) * (y - p))), 5) AS rmse, round(avg(abs(y - p)), 5) AS mae,
       round(1.0 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 5) AS r2
FROM both_scales GROUP BY scale
"""


@query("fixed_model_metrics", ("REG-02", "REG-03", "REG-06", "REG-07", "AGG-33", "FIL-12"), _fixed_sql())
def fixed_model_metrics(spark, sf_dir):
    """RMSE, MAE and R² on both scales of given coefficients over nine prepared numerics."""
    frame = _heard(spark, sf_dir)
    meta = G.fit_prep(frame, NINE, "listens")
    pred = G.predict_linear(FIXED, G.apply_prep(frame, meta, target="listens"), meta.target_min, meta.target_max)
    return G.evaluate(pred).select("scale", *[F.round(c, 5).alias(c) for c in ("rmse", "mae", "r2")])


@query("smooth_l1_gradient", ("REG-05",), "SELECT unnest([" + ", ".join(f"'{f}'" for f in [*NINE, "intercept"]) + "]) AS feature, 0.0::DOUBLE AS slope")
def smooth_l1_gradient(spark, sf_dir):
    """The slope of the mean Smooth-L1 loss along each coefficient, at the fitted ones: zero, as at any least loss."""
    frame = _heard(spark, sf_dir)
    rows = cut_lineage(G.apply_prep(frame, G.fit_prep(frame, NINE), target="listens"), "regression-rows")
    fit = G.fit_smooth_l1(rows, NINE)
    step = F.least(F.greatest(F.col("label") - fit.prediction(), F.lit(-1.0)), F.lit(1.0))
    slopes = [F.struct(F.lit(f).alias("feature"), F.abs(F.round(F.avg(step * (F.lit(1.0) if f == "intercept" else F.col(f))), 6)).alias("slope"))
              for f in [*NINE, "intercept"]]
    return rows.agg(F.array(*slopes).alias("s")).select(F.explode("s").alias("s")).select("s.*")


@query("listens_regression_metrics", ("REG-04", "REG-05", "REG-06", "REG-07", "AGG-33", "FIL-12"))
def listens_regression_metrics(spark, sf_dir):
    frame = _heard(spark, sf_dir)
    meta, model, pred = G.listens_model(frame, "p_partkey", NINE, "listens", seed=1234)
    return G.evaluate(pred.filter(F.col("split") == "test"))


@query("listens_predictions", ("REG-06", "SRC-15"))
def listens_predictions(spark, sf_dir):
    frame = _heard(spark, sf_dir)
    meta, model, pred = G.listens_model(frame, "p_partkey", NINE, "listens", seed=1234)
    return pred.select(F.col("p_partkey").alias("track_id"), rnd("predicted").alias("predicted_listens"),
                       F.coalesce(rnd(F.expm1("label")), F.lit(-1.0)).alias("actual_listens"))
