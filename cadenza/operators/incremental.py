"""Entity counters that are kept up to date by deltas (DRV-11, UDF-04).

An entity's counter is the sum of a measure over the items that are linked to
it.  Three tables are kept: what the events did to each item's counters (the
pairs of :func:`derived.floor_moves`), the links with the number of relations
that hold each, and the entities' sums.  A batch of events and of link changes
reads only the buckets of the items it names, forms the entities' differences

    sum over links of  held before * (value now - value before)
                     + (held now - held before) * value now

and adds them to the entities' rows.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, discard
from ..sources.buckets import BucketedTable
from .derived import floor_moves, floored, then_moves


def _add(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of the columns besides ``keys``."""
    both = old.unionByName(new)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in both.columns if c not in keys])


class EntityCounters:
    """Sums of item counters per entity, under ``base``.

    ``deltas``: counter name -> step of an event (a Column over the events).  An
    item belongs to an entity while at least one relation (main, featured ...)
    links them.  Batches are numbered; one that is run again, after a crash,
    gives the same tables.
    """

    def __init__(self, spark: SparkSession, base: str, item: str, entity: str, deltas: Mapping[str, Column],
                 order: Sequence[str], kind: str = "long", buckets: int = 16):
        self.item, self.entity, self.deltas, self.order, self.names = item, entity, dict(deltas), list(order), list(deltas)

        def table(name, keys, columns, spread=None):
            schema = spark.createDataFrame([], ", ".join(f"{c} {kind if c in (item, entity) else 'long'}" for c in columns)).schema
            return BucketedTable(spark, f"{base.rstrip('/')}/{name}", keys, schema, buckets)

        self.moves = table("moves", [item], [item, *[f"{n}_{x}" for n in self.names for x in ("total", "low")]])
        # links lie in the bucket of their item; rows of one item and entity are summed up on reading
        self.links = table("links", [item], [item, entity, "relations"])
        self.sums = table("sums", [entity], [entity, *self.names])

    def _values(self, moves: DataFrame, suffix: str) -> DataFrame:
        return moves.select(self.item, *[floored(n).alias(f"{n}_{suffix}") for n in self.names])

    def refresh(self, epoch: int, events: DataFrame, links: DataFrame) -> DataFrame:
        """Take in ``events`` and ``links`` (item, entity, change: +1 for each new relation, -1 for each that ends).

        Returns the rows of the touched entities, as they are now.  Null items and entities are left out.
        """
        item, entity, names = self.item, self.entity, self.names
        step = cut_lineage(floor_moves(events, item, self.deltas, self.order), "refresh-moves")
        change = links.filter(F.col(item).isNotNull() & F.col(entity).isNotNull()).groupBy(item, entity) \
            .agg(F.sum("change").cast("long").alias("relations")).filter("relations <> 0")
        change = cut_lineage(change, "refresh-links")
        items = step.select(item).unionByName(change.select(item)).distinct()

        before = self.moves.read(items, below=epoch).join(items, item, "left_semi")
        now = then_moves(before, step, item, names)
        value = self._values(now, "now").join(self._values(before, "was"), item, "left")
        held = self.links.read(items, below=epoch).join(items, item, "left_semi").withColumn("was", F.lit(True))
        after = held.unionByName(change.withColumn("was", F.lit(False))).groupBy(item, entity).agg(
            (F.sum(F.when(F.col("was"), F.col("relations")).otherwise(0)) > 0).cast("long").alias("held"),
            (F.sum("relations") > 0).cast("long").alias("holds"))
        moved = after.join(value, item, "left")
        difference = [(F.col("held") * (F.coalesce(f"{n}_now", F.lit(0)) - F.coalesce(f"{n}_was", F.lit(0)))
                       + (F.col("holds") - F.col("held")) * F.coalesce(f"{n}_now", F.lit(0))) for n in names]
        difference = moved.groupBy(entity).agg(*[F.sum(d).cast("long").alias(n) for n, d in zip(names, difference)])
        difference = cut_lineage(difference, "refresh-sums")

        # written after everything that is read as it stood before
        self.moves.merge(step, epoch, lambda old, new, _: then_moves(old, new, item, names))
        self.links.merge(change, epoch, lambda old, new, _: _add(old, new, [item, entity]).filter("relations <> 0"))
        self.sums.merge(difference, epoch, _add)
        for t in (step, change):
            discard(t)
        return self.sums.read(difference).join(difference.select(entity), entity, "left_semi")
