"""Shared table shapes for the plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import priority_merge
from ..session import tasks_for
from ..sources.tables import load_table


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` in tasks of about ``rows`` rows: a file of few bytes is one task else, whatever is computed for its rows."""
    return df.repartition(tasks_for(df.count(), rows))


def rnd(col, digits: int = 6):
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits)


def merged_facts(spark: SparkSession, sf_dir: str, li_cols=(), order_cols=("o_orderdate",),
                 part_cols=("p_type",)) -> DataFrame:
    """The minimum-slice fact table: lineitem ⟕ orders ⟕ part by priority merge.

    Only the columns a query names are selected, so the scans read just those.
    """
    li = T(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), *li_cols)
    orders = T(spark, sf_dir, "orders").select("o_orderkey", *order_cols)
    part = T(spark, sf_dir, "part").select("p_partkey", *part_cols)
    m = priority_merge(li, orders, "o_orderkey", suffix="order")
    return priority_merge(m, part, "p_partkey", suffix="part")
