"""Derived state: the source's row triggers re-aimed as set-based operators
(DRV-01 … DRV-12).  Each computes the state the trigger chain converges to,
in one aggregate or join, instead of replaying events row by row.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import surrogate_id
from ..session import cut_lineage


def child_count(parent: DataFrame, child: DataFrame, key: str, alias: str = "n_children") -> DataFrame:
    """DRV-01: per-parent child count (0 when none; a count, not ±1 drift — Q-07 fixed)."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
    return parent.join(counts, key, "left").withColumn(alias, F.coalesce(F.col(alias), F.lit(0)))


def singles_for_orphans(items: DataFrame, id_col: str, parent_col: str, title_col: str,
                        date_col: str | None = None, as_of=None) -> DataFrame:
    """DRV-02: a 'single' parent for every item without one."""
    orphans = items.filter(F.col(parent_col).isNull())
    created = F.col(date_col).cast("date") if date_col else F.lit(None).cast("date")
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return orphans.select(surrogate_id("album", F.col(id_col)).alias("album_uuid"), F.col(id_col),
                          F.concat(F.col(title_col), F.lit(" - Single")).alias("album_title"),
                          F.lit("single").alias("album_type"),
                          F.coalesce(created, today).alias("album_date_released"),
                          F.lit(0).alias("album_listens"), F.lit(0).alias("album_favorites"))


def track_defaults(tracks: DataFrame, track: str, tables: Mapping[str, tuple[DataFrame, Mapping[str, object]]]) -> dict[str, DataFrame]:
    """DRV-03: the row that every new track gets in each dependant table (rank, audio, temporal) when it has none.

    ``tables``: name -> (existing rows, default values); a default of None is a null of the column's type.
    """
    out = {}
    for name, (existing, defaults) in tables.items():
        missing = tracks.select(track).distinct().join(existing.select(track), track, "left_anti")
        new = missing.select(track, *[F.lit(v).cast(existing.schema[c].dataType).alias(c) for c, v in defaults.items()])
        out[name] = existing.select(track, *defaults).unionByName(new)
    return out


def default_rows(entities: DataFrame, existing: DataFrame, key: str, defaults: dict) -> DataFrame:
    """DRV-03/10/12 / UPS-02: a default row for each entity lacking one."""
    missing = entities.select(key).distinct().join(existing.select(key), key, "left_anti")
    new = missing.select(key, *[F.lit(v).alias(c) for c, v in defaults.items()])
    return existing.select(key, *defaults.keys()).unionByName(new)


def cascade_delete(dependant: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """DRV-04: dependants of deleted ids removed (left anti)."""
    return dependant.join(deleted.select(key).distinct(), key, "left_anti")


def cascade_delete_tables(tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]], root: str,
                          deleted: DataFrame) -> dict[str, DataFrame]:
    """DRV-04 over a graph of tables: what is left of ``root`` and of every table that hangs on it.

    ``references``: (child table, its column, parent table, parent's key).  ``deleted``
    holds the keys of the rows of ``root`` that go, in one column named as the key
    that its children refer to.  Tables are taken in the order of their references;
    a row goes with any parent row that it refers to, and its own children with it.
    Deleted keys are written once per table that has children, so each
    dependant costs one anti join per reference against a table of keys.
    """
    children = {}
    for child, column, parent, key in references:
        children.setdefault(parent, []).append((child, column, key))
    reach, queue = {root}, [root]
    while queue:
        for child, _, _ in children.get(queue.pop(), []):
            if child not in reach:
                reach.add(child)
                queue.append(child)
    waiting = {t: {p for c, _, p, _ in references if c == t and p in reach} for t in reach}
    waiting[root] = set()
    left, gone = {}, {}
    while waiting:
        ready = sorted(t for t, parents in waiting.items() if not parents)
        if not ready:
            raise ValueError(f"references form a cycle among {sorted(waiting)}")
        for table in ready:
            del waiting[table]
            for parents in waiting.values():
                parents.discard(table)
            df, own = tables[table], sorted({key for _, _, key in children.get(table, [])})
            if table == root:
                named = deleted.columns[0]
                hits = [(named, deleted.select(F.col(named).alias("__gone")).dropna().distinct())]
            else:
                hits = [(column, gone[parent, key]) for child, column, parent, key in references if child == table and parent in reach]
            rest = df
            for column, keys in hits:
                rest = rest.join(keys, F.col(column) == F.col("__gone"), "left_anti")
            left[table] = rest
            for key in own:
                rows = reduce(DataFrame.unionByName, [df.join(keys, F.col(column) == F.col("__gone"), "left_semi").select(F.col(key).alias("__gone"))
                                                      for column, keys in hits])
                gone[table, key] = cut_lineage(rows.dropna().distinct(), f"deleted-{table}")
    return left


def blocked_deletes(requested: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """DRV-05: requested parent deletions that must be refused (children exist)."""
    return requested.select(key).distinct().join(child.select(key), key, "left_semi")


def _time_slot(events: DataFrame, col: str, slots: int) -> Column:
    """Slot of each row in ``slots`` ranges of about equal row counts of ``col`` (a time, date or number); nulls are in the first."""
    kind = events.schema[col].dataType
    at = F.unix_micros(F.col(col).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else F.col(col)
    cuts = events.agg(F.percentile_approx(at, [i / slots for i in range(1, slots)], 10000)).first()[0] or []
    return F.coalesce(reduce(add, [(at >= F.lit(c)).cast("int") for c in sorted(set(cuts))], F.lit(0)), F.lit(0))


def floor_moves(events: DataFrame, key: str, deltas: Mapping[str, Column], order: Sequence[str], slots: int = 32) -> DataFrame:
    """DRV-06/08: what the events of each key do to counters that are floored at 0 at every step.

    A counter of value x becomes max(x + d, 0) with each event, in ``order``.
    Over a run of events that is x -> total + max(x, -low), where ``total`` is
    the sum of the steps and ``low`` the least sum of a beginning of the run (0
    for the empty one).  Two runs one after the other give
    (t1 + t2, min(low1, t1 + low2)), so a key's events are cut into ranges of
    time, each range is summed up by a task of its own, and the ranges of a key
    are put together: a hot key is never sorted in one task.

    Returns (key, ``<name>_total``, ``<name>_low`` for each counter); null keys
    and events that move nothing are left out.  ``order`` must tell events of a
    key apart; ranges are cut by its first column.
    """
    names = list(deltas)
    rows = events.select(F.col(key), *order, *[F.coalesce(d, F.lit(0)).cast("long").alias(f"__d_{n}") for n, d in deltas.items()])
    rows = rows.filter(F.col(key).isNotNull() & reduce(lambda x, y: x | y, [F.col(f"__d_{n}") != 0 for n in names]))
    rows = rows.withColumn("__slot", _time_slot(rows, order[0], slots))
    within = Window.partitionBy(key, "__slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(key, "__slot", *[f"__d_{n}" for n in names], *[F.sum(f"__d_{n}").over(within).alias(f"__r_{n}") for n in names])
    part = rows.groupBy(key, "__slot").agg(*[x for n in names for x in (F.sum(f"__d_{n}").alias(f"__t_{n}"), F.min(f"__r_{n}").alias(f"__l_{n}"))])
    earlier = Window.partitionBy(key).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("*", *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n in names])
    return part.groupBy(key).agg(*[x for n in names for x in (
        F.sum(f"__t_{n}").alias(f"{n}_total"), F.least(F.lit(0), F.min(F.col(f"__b_{n}") + F.col(f"__l_{n}"))).alias(f"{n}_low"))])


def then_moves(first: DataFrame, second: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The moves of ``first`` followed by those of ``second``, per key."""
    later = second.select(F.col(key).alias("__k"), *[F.col(f"{n}_{x}").alias(f"__{n}_{x}") for n in names for x in ("total", "low")])
    both = first.join(later, F.col(key) == F.col("__k"), "full_outer")
    of = {c: F.coalesce(F.col(c), F.lit(0)) for n in names for x in ("total", "low") for c in (f"{n}_{x}", f"__{n}_{x}")}
    return both.select(F.coalesce(key, "__k").alias(key), *[x for n in names for x in (
        (of[f"{n}_total"] + of[f"__{n}_total"]).alias(f"{n}_total"),
        F.least(of[f"{n}_low"], of[f"{n}_total"] + of[f"__{n}_low"]).alias(f"{n}_low"))])


def floored(name: str, start: Column | int = 0) -> Column:
    """Value of a counter after its moves, from ``start``."""
    before = start if isinstance(start, Column) else F.lit(start)
    return (F.col(f"{name}_total") + F.greatest(before, -F.col(f"{name}_low"))).cast("long")


def signed_counter(events: DataFrame, key: str, op_col: str, order: Sequence[str], insert_value: str = "insert",
                   alias: str = "n") -> DataFrame:
    """DRV-06/08: +1 per insert, -1 per any other event, floored at 0 at every step."""
    d = F.when(F.col(op_col) == insert_value, F.lit(1)).otherwise(F.lit(-1))
    return floor_moves(events, key, {alias: d}, order).select(key, floored(alias).alias(alias))


def distinct_pair_counter(events: DataFrame, item: str, user: str, alias: str = "n_listeners") -> DataFrame:
    """DRV-07: +1 per *new* (user, item) pair ⇒ distinct users per item.

    Written as dedupe-then-count so the shuffle is on (item, user): a hot item
    spreads over many tasks before its final per-item sum.
    """
    return (events.select(item, user).dropna().distinct()
            .groupBy(item).agg(F.count(F.lit(1)).alias(alias)))


def first_owned(users_acting: DataFrame, owners: DataFrame, user: str, entity: str = "playlist",
                title: str = "My first playlist") -> DataFrame:
    """DRV-09: a first owned row for acting users that own none."""
    need = users_acting.select(user).distinct().join(owners.select(user), user, "left_anti")
    return need.select(surrogate_id(entity, F.col(user)).alias(f"{entity}_uuid"), user,
                       F.lit(title).alias(f"{entity}_title"))


def rollup_over_links(entities: DataFrame, key: str, main_links: DataFrame, feat_links: DataFrame,
                      item_key: str, items: DataFrame, measures: Sequence[str]) -> DataFrame:
    """DRV-11 / JOIN-12 / AGG-30: entity counters = sums over items linked as
    main OR featured (each item once per entity), 0 when none."""
    links = (main_links.select(key, item_key).unionByName(feat_links.select(key, item_key)).distinct())
    sums = (links.join(items.select(item_key, *measures), item_key)
            .groupBy(key).agg(*[F.sum(m).alias(f"total_{m}") for m in measures]))
    out = entities.join(sums, key, "left")
    for m in measures:
        out = out.withColumn(f"total_{m}", F.coalesce(F.col(f"total_{m}"), F.lit(0)))
    return out


def item_counters(events: DataFrame, item: str, type_col: str, user: str, order: Sequence[str], *, like: str, unlike: str,
                  listen: str, comment: str, uncomment: str | None = None) -> DataFrame:
    """DRV-06/07/08: likes and comments (up and down one by one, never below 0)
    and distinct listeners of every item that any event names."""
    t = F.col(type_col)
    rows = events.filter(F.col(item).isNotNull())
    back = (t == uncomment) if uncomment is not None else F.lit(False)
    moves = floor_moves(rows, item, {"likes": F.when(t == like, 1).when(t == unlike, -1),
                                     "comments": F.when(t == comment, 1).when(back, -1)}, order)
    heard = distinct_pair_counter(rows.filter(t == listen), item, user, "listeners")
    out = rows.select(item).distinct().join(moves, item, "left").join(heard, item, "left")
    return out.select(item, *[F.coalesce(floored(n), F.lit(0)).alias(n) for n in ("likes", "comments")],
                      F.coalesce("listeners", F.lit(0)).alias("listeners"))
