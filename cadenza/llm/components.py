"""Connected components of an edge table, by alternating star contraction.

Each round hangs every node's larger neighbours, then its smaller ones, under
the smallest neighbour it knows (two aggregates and two joins).  Node degrees
are pre-aggregated, and a join on a hot centre meets one row of the other side,
which the adaptive skew join splits.  Rounds are written to the shared folder.
What a round shuffles goes to one task for each EDGES edges, however many
partitions the session has: rounds are many and late ones are short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, discard, tasks_for

#: Edges, in both directions, that a task of a round takes.
EDGES = 200_000


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); label: its component's smallest node."""
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a <> b").distinct(), "cc")
    mark = _mark(now)
    while True:
        tasks = tasks_for(2 * mark[0], EDGES)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(tasks)
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        small_low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        small = large.join(small_low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks)
        before = now
        now = cut_lineage(small.unionByName(small_low.select("a", F.col("m").alias("b")))
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").coalesce(tasks).distinct().coalesce(tasks), "cc")
        discard(before)
        after = _mark(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))
