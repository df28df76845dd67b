"""Sharding by proportional stratified interleaving (operator 3), with DataFrame functions only.

Rows are shuffled by a seeded hash and ranked within their source.  The
fractional rank ``(rank + start) / rows of the source`` spreads every source
evenly over 0 to 1 (``start`` in 0 to 1 is the source's own, so that sources of
one row do not meet in one place).  In the order of fractional ranks, cutting
into equal runs gives every shard its share of every source: a stretch of the
order holds each source's share of it to within one row, and a shard's stretch
differs from an equal one only by what the sources' roundings add up to (random
starts let these cancel).

No window holds a whole source or the whole table: ranks are counted over
ranges of the hash (then of the fractional rank), whose counts are added up
beforehand.  The ranges grow with the table, so each holds about RUN rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

RUN = 4096


def _unit(text: Column) -> Column:
    """A number in 0 to 1 (32 bits) from the hash of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _before(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows in the ranges before each range (of the same ``by``), and in all of them."""
    # one row per range: a window over them is one over a few thousandths of the rows
    within = Window.partitionBy(*by).orderBy(order)
    return counts.withColumn("before", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("before", F.coalesce("before", F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))


def interleave(df: DataFrame, source: Column, key: Column, ties: list[Column], shards: int, seed: int = 1) -> DataFrame:
    """Deal every row to one of ``shards`` shards, whose sizes differ by one row at most.

    Returns the columns of ``df`` as struct ``row``, and shard int, slot long
    (gapless from 0 in each shard), source_rank long (from 0), fraction double.
    ``key`` is hashed with the seed for the shuffle, ``ties`` order rows of one
    hash; rows equal in all of these are interchangeable.  A null source is a
    source of its own, a null key hashes as one.  An empty table gives none.
    """
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), source.cast("string").alias("source"),
                     F.md5(name.cast("binary")).alias("h"), _unit(name).alias("unit"), *[t.alias(f"tie{i}") for i, t in enumerate(ties)])
    rows = cut_lineage(rows, "shard-rows")
    n = rows.count()
    ranges = F.lit(float(max(1, -(-n // RUN))))
    order = ["h", *[f"tie{i}" for i in range(len(ties))]]
    rows = rows.withColumn("part", F.floor(F.col("unit") * ranges))

    counts = rows.groupBy("source", "part").agg(F.count("*").alias("n"))
    at = _before(counts, ["source"], "part").select(F.col("source").alias("s"), F.col("part").alias("p"), "before", "total")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("source", "part").orderBy(*order)) - 1) \
        .join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))) \
        .withColumn("source_rank", F.col("before") + F.col("rank")) \
        .withColumn("fraction", (F.col("source_rank") + _unit(F.concat(F.lit(f"{seed}:source:"), F.coalesce("source", F.lit("null")))))
                    / F.col("total")).drop("s", "p", "part", "before", "total", "rank", "unit")
    ranked = cut_lineage(ranked.withColumn("part", F.floor(F.col("fraction") * ranges)), "shard-ranked")

    # one level more, as the ranges of the whole table are themselves too many for one window at scale
    counts = ranked.groupBy("part").agg(F.count("*").alias("n")).withColumn("top", F.floor(F.col("part") / RUN))
    tops = _before(counts.groupBy("top").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0)), ["all"], "top") \
        .select(F.col("top").alias("t"), F.col("before").alias("earlier"))
    at = _before(counts, ["top"], "part").join(tops, F.col("top") == F.col("t")) \
        .select(F.col("part").alias("p"), (F.col("before") + F.col("earlier")).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("fraction", *order, F.col("source").asc_nulls_first())) - 1
    placed = ranked.join(at, F.col("part") == F.col("p")).withColumn("place", place)
    # place and shard in whole numbers: shard s holds places ceil(s * n / shards) to ceil((s + 1) * n / shards) - 1
    shard = F.expr(f"cast(place * {shards} div {max(1, n)} as int)")
    return placed.withColumn("shard", shard).select(
        "row", "shard", F.expr(f"place - (cast(shard as bigint) * {n} + {shards} - 1) div {shards}").alias("slot"), "source_rank", "fraction")
