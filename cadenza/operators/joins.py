"""Join operators (JOIN-01 … JOIN-18).

All joins are declared with the DataFrame API; the physical strategy is left
to Catalyst + AQE.  A side is broadcast explicitly only when its size is
bounded by construction (a single target row, a top-n list) -- never because
it "looks small" on the test data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority_merge(base: DataFrame, other: DataFrame, key: str | Sequence[str], *,
                   suffix: str = "other", drop: Sequence[str] | None = None,
                   rename: dict[str, str] | None = None) -> DataFrame:
    """JOIN-01/04: left join where ``base`` columns stay authoritative.

    Columns present on both sides keep the base value and are filled from
    ``other`` only where the base value is null.  Right-only columns are
    appended.  Duplicate right keys multiply rows, exactly like a left join.
    One ``select`` after the join: no intermediate suffix columns survive.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rhs = other
    if drop:
        rhs = rhs.drop(*drop)
    if rename:
        rhs = rhs.withColumnsRenamed(rename)
    b, o = base.alias("__b"), rhs.alias("__o")
    overlap = [c for c in rhs.columns if c in base.columns and c not in keys]
    right_only = [c for c in rhs.columns if c not in base.columns and c not in keys]
    joined = b.join(o, on=keys, how="left")
    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in overlap:
            out.append(F.coalesce(F.col(f"__b.`{c}`"), F.col(f"__o.`{c}`")).alias(c))
        else:
            out.append(F.col(f"__b.`{c}`").alias(c))
    out += [F.col(f"__o.`{c}`").alias(c) for c in right_only]
    return joined.select(*out)


def explode_join(df: DataFrame, list_col: str, dim: DataFrame, dim_key: str,
                 out_key: str | None = None, how: str = "left") -> DataFrame:
    """JOIN-02/14: explode a list key, then join a dimension on it.

    ``explode_outer`` keeps rows whose list is empty or null as one row with a
    null key, as the source application does.  Use ``how='inner'`` for the
    ``CROSS JOIN LATERAL unnest`` form that drops them.
    """
    out_key = out_key or dim_key
    exploder = F.explode_outer if how == "left" else F.explode
    expanded = df.withColumn(out_key, exploder(F.col(list_col)))
    right = dim if out_key == dim_key else dim.withColumnRenamed(dim_key, out_key)
    return expanded.join(right, out_key, how)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   value_cols: Sequence[str] | None = None,
                   tie_cols: Sequence[str] = ()) -> DataFrame:
    """JOIN-08: latest row per key (``LATERAL … ORDER BY ts DESC LIMIT 1``).

    ``max_by`` over a struct is a plain aggregate: it combines map-side, so a
    hot key costs one partial row per task instead of a sorted window
    partition.  Ties on ``order_col`` are broken by ``tie_cols`` (largest wins)
    so the answer is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    value_cols = list(value_cols or [c for c in df.columns if c not in keys])
    ordering = F.struct(*[F.col(c) for c in [order_col, *tie_cols]])
    payload = F.struct(*[F.col(c) for c in value_cols])
    agg = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("__latest"))
    return agg.select(*keys, *[F.col(f"__latest.`{c}`").alias(c) for c in value_cols])


def latest_per_key_rn(df: DataFrame, key: str, order_col: str,
                      tie_cols: Sequence[str] = ()) -> DataFrame:
    """JOIN-09 / WIN-01: the ``row_number() = 1`` formulation (same result)."""
    w = Window.partitionBy(key).orderBy(F.desc(order_col), *[F.desc(c) for c in tie_cols])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def attach_latest(entity: DataFrame, history: DataFrame, key: str, order_col: str,
                  value_cols: Sequence[str], tie_cols: Sequence[str] = ()) -> DataFrame:
    """JOIN-08 as a view: entity left-joined with its latest history row."""
    latest = latest_per_key(history, key, order_col, value_cols, tie_cols)
    return entity.join(latest, key, "left")


def parent_resolve(df: DataFrame, id_col: str, parent_col: str, out_col: str,
                   payload_col: str | None = None, root_values=(0,)) -> DataFrame:
    """JOIN-07: self-join to resolve one parent level; root values map to null."""
    parent_key = F.when(F.col(parent_col).isin(*root_values), F.lit(None)).otherwise(F.col(parent_col))
    child = df.withColumn("__pkey", parent_key)
    cols = [F.col(id_col).alias("__pid")]
    if payload_col:
        cols.append(F.col(payload_col).alias(out_col))
    else:
        cols.append(F.col(id_col).alias(out_col))
    parents = df.select(*cols)
    return (child.join(parents, child["__pkey"] == parents["__pid"], "left")
            .drop("__pkey", "__pid"))


def anti_join(df: DataFrame, exclude: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """JOIN-11 / SET-06: ``NOT EXISTS`` as a left-anti join."""
    return df.join(exclude, key, "left_anti")


def semi_join(df: DataFrame, keep: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """FIL-10 / JOIN-12: ``EXISTS`` / ``= ANY(...)`` as a left-semi join."""
    return df.join(keep, key, "left_semi")


def exists_in_either(df: DataFrame, key: str, first: DataFrame, second: DataFrame,
                     other_key: str | None = None) -> DataFrame:
    """JOIN-12: rows with a match in ``first`` OR ``second``.

    Union of both key sets, de-duplicated, then one semi join -- equivalent to
    the OR of two EXISTS without a nested-loop plan.
    """
    ok = other_key or key
    keys = first.select(F.col(ok).alias(key)).union(second.select(F.col(ok).alias(key))).distinct()
    return df.join(keys, key, "left_semi")


def nested_lookup(entity: DataFrame, child: DataFrame, key: str, out_col: str,
                  fields: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """JOIN-13 / AGG-22: correlated JSON-array sub-query as group + left join.

    The child rows are aggregated once per key (partial aggregation runs
    before the shuffle) and joined back; keys with no child get NULL, as the
    correlated sub-query does.  ``order_by`` fields lead the struct so
    ``array_sort`` gives the requested order; they are dropped afterwards.
    """
    order_by = list(order_by or [])
    sort_fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
    item = F.struct(*sort_fields, *[F.col(c) for c in fields])
    agg = child.groupBy(key).agg(F.collect_list(item).alias("__items"))
    if order_by:
        agg = agg.withColumn("__items", F.array_sort("__items"))
        agg = agg.withColumn("__items", F.transform("__items", lambda s: F.struct(*[s[c].alias(c) for c in fields])))
    return entity.join(agg.withColumnRenamed("__items", out_col), key, "left")


def children_long(entity: DataFrame, child: DataFrame, key: str, fields: Sequence[str],
                  order_by: Sequence[str]) -> DataFrame:
    """JOIN-13 / AGG-22 in long form: (key, position, fields) for every child
    of an entity, in ``order_by`` order; entities without children keep one
    row with a null position.  No array is built, so an entity with an
    unbounded number of children never becomes one giant value; positions
    come from a spilling per-key sort."""
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order_by])
    ranked = child.select(key, *fields, *[c for c in order_by if c not in fields]).withColumn(
        "position", F.row_number().over(w))
    return entity.select(key).join(ranked.select(key, "position", *fields), key, "left")


def ci_equi_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                 how: str = "inner") -> DataFrame:
    """JOIN-15: ``lower(a) = lower(b)`` as an equi-join on normalised keys."""
    l = left.withColumn("__ci", F.lower(F.col(left_col)))
    r = right.withColumn("__ci", F.lower(F.col(right_col)))
    return l.join(r, "__ci", how).drop("__ci")


def null_if(col: str, cond: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(F.col(col))
