"""Aggregations, windows, top-k, filters and set operations.

Scale notes that hold for the whole module:

* Totals for shares are scalar sub-queries (``DataFrame.scalar()``): one
  partial-aggregated job whose single value is inlined; no single-partition
  window over the data.
* Top-n label lists come from ``orderBy(...).limit(n)`` (per-task top-n, then a
  merge of n x tasks rows), and are joined back with an explicit broadcast:
  their size is bounded by ``n``.
* Group statistics that must meet their rows again (leave-one-out means,
  duplicate flags, group-size filters) are computed with ``groupBy`` (map-side
  combine) and joined back, not with an unordered window that would pull a
  hot group into one task.  AQE's skew-join splits hot keys on the big side.
* Exact group quantiles run over (value, frequency) pairs cut into ranges: only
  the range that holds the wanted rank is sorted.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Labels treated as junk by the chart filter (after trim + lower).
JUNK_LABELS = ["", "nan", "none", "null", "unknown", "n/a", "na"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------- filters

def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FIL-01: drop rows with a null (or NaN) in any of ``cols``."""
    return df.dropna(subset=list(cols))


def keep_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """FIL-02: value in a literal list."""
    return df.filter(F.col(col).isin(list(values)))


def reject_junk_labels(df: DataFrame, col: str, junk: Sequence[str] = JUNK_LABELS) -> DataFrame:
    """FIL-03: drop null labels and junk labels after trim + lower; trims the label."""
    t = F.trim(F.col(col))
    return df.filter(F.col(col).isNotNull() & ~F.lower(t).isin(list(junk))).withColumn(col, t)


def keep_groups_min_rows(df: DataFrame, key: str | Sequence[str], min_rows: int) -> DataFrame:
    """FIL-05/06: keep rows of groups that have at least ``min_rows`` rows."""
    keys = [key] if isinstance(key, str) else list(key)
    big = df.groupBy(*keys).count().filter(F.col("count") >= min_rows).select(*keys)
    return df.join(big, keys, "left_semi")


def clip(col, lower=None, upper=None) -> Column:
    """FIL-12: clip to a lower bound and/or an upper bound."""
    c = _c(col)
    if lower is not None:
        c = F.greatest(c, F.lit(lower))
    if upper is not None:
        c = F.least(c, F.lit(upper))
    return c


def having(df: DataFrame, keys: Sequence[str], agg: Column, alias: str, cond: Column) -> DataFrame:
    """FIL-11: ``GROUP BY … HAVING``."""
    return df.groupBy(*keys).agg(agg.alias(alias)).filter(cond)


# ------------------------------------------------------------ aggregations

def mean_by_group(df: DataFrame, key: str, value: str, alias: str = "mean_value") -> DataFrame:
    """AGG-01 / CH-02: mean of ``value`` by ``key`` over non-null rows, ascending."""
    return (df.dropna(subset=[key, value]).groupBy(key)
            .agg(F.avg(value).alias(alias)).orderBy(alias, key))


def sum_by_group(df: DataFrame, key: str, value: str, alias: str = "total") -> DataFrame:
    """AGG-02: sum by group, descending (ties by key)."""
    return (df.dropna(subset=[key, value]).groupBy(key)
            .agg(F.sum(value).alias(alias)).orderBy(F.desc(alias), key))


def top_labels(totals: DataFrame, label: str, score: str, n: int) -> DataFrame:
    """TOP-02/03: the ``n`` best labels by ``score`` (ties by label); ≤ n rows."""
    return totals.orderBy(F.desc(score), F.asc(label)).limit(n).select(label)


def top_n_with_others(df: DataFrame, label: str, value: str | None, n: int,
                      others: str = "Others", alias: str = "total") -> DataFrame:
    """AGG-03/04 / SET-05: top-n labels by total, the rest summed as ``others``.

    ``value=None`` counts rows.  Adds ``share`` (% of the grand total, null
    when the total is 0).  The roll-up row appears only when there are more
    than ``n`` labels, as in the source application.
    """
    base = df.dropna(subset=[label] + ([value] if value else []))
    measure = F.sum(value) if value else F.count(F.lit(1))
    totals = base.groupBy(label).agg(measure.alias(alias))
    head = top_labels(totals, label, alias, n).withColumn("__top", F.lit(True))
    marked = totals.join(F.broadcast(head), label, "left")
    rolled = (marked.withColumn(label, F.when(F.col("__top"), F.col(label)).otherwise(F.lit(others)))
              .groupBy(label).agg(F.sum(alias).alias(alias)))
    grand = totals.agg(F.sum(alias)).scalar()
    return rolled.withColumn("share", 100.0 * F.col(alias) / F.nullif(grand, F.lit(0)))


def value_shares(df: DataFrame, col: str, alias: str = "proportion") -> DataFrame:
    """AGG-05 / CH-03: normalised value counts, descending."""
    counts = df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(alias, F.col("n") / total).orderBy(F.desc(alias), col)


def exploded_value_counts(df: DataFrame, list_col: str, out: str = "value") -> DataFrame:
    """AGG-06: value counts of an exploded list column."""
    return (df.select(F.explode(F.col(list_col)).alias(out))
            .groupBy(out).agg(F.count(F.lit(1)).alias("count")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG-07: value counts of a scalar column (nulls dropped)."""
    return df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def group_means(df: DataFrame, key: str, values: Sequence[str], count_col: str | None = None,
                count_alias: str = "n_rows") -> DataFrame:
    """AGG-08/10: means of several columns plus a row count per key."""
    aggs = [F.avg(v).alias(f"avg_{v}") for v in values]
    aggs.append(F.count(F.col(count_col) if count_col else F.lit(1)).alias(count_alias))
    return df.groupBy(key).agg(*aggs)


def frequency_quantiles(df: DataFrame, col: str, probs: Sequence[float], prefix: str = "q") -> DataFrame:
    """AGG-09: exact, linearly interpolated quantiles of a column (one row), by histogram refinement."""
    from .quantiles import exact_quantiles
    found = exact_quantiles(df, [col], [float(p) for p in probs])[col]
    values = {f"{prefix}{int(round(p * 100))}": v for p, v in zip(probs, found)}
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(name) for name, v in values.items()])


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """AGG-14: exact median by group (rows reduced to value frequencies first)."""
    freq = cut_lineage(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__f")), "frequencies")
    return median_from_frequencies(freq, keys, value, "__f", alias)


#: Ranges that a group's distinct values are cut into.
_RANGES = 64


def median_from_frequencies(freq: DataFrame, keys: Sequence[str], value: str, count: str, alias: str,
                            q: float = 0.5) -> DataFrame:
    """Exact, linearly interpolated quantile per group from (keys, value, count).

    A group's distinct values are cut into ``_RANGES`` ranges at approximate
    quantiles (a sketch of bounded size per group).  The counts of the ranges,
    added up in order, name the one or two that hold the wanted ranks; only
    their values are sorted, so a hot group costs one task a small part of its
    values.  The sketch moves the cuts, never the result.  ``freq`` is read
    three times: pass a written table.
    """
    keys = list(keys)
    cuts = F.percentile_approx(F.col(value), [i / _RANGES for i in range(1, _RANGES)], 1000)
    groups = freq.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.sum(count).alias("__qtot"), cuts.alias("__qcuts"))
    rows = freq.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__qv"), F.col(count).alias("__qn")).join(groups, keys) \
        .withColumn("__qr", F.size(F.filter("__qcuts", lambda c: c < F.col("__qv")))).drop("__qcuts")
    ranges = rows.groupBy(*keys, "__qr").agg(F.sum("__qn").alias("__qm"), F.first("__qtot").alias("__qt"))
    upto = Window.partitionBy(*keys).orderBy("__qr").rowsBetween(Window.unboundedPreceding, 0)      # at most _RANGES rows
    pos = (F.col("__qt") - 1) * F.lit(q)
    ranges = ranges.withColumn("__qb", F.sum("__qm").over(upto) - F.col("__qm")).withColumn("__qpos", pos) \
        .withColumn("__qlo", F.floor("__qpos")).withColumn("__qhi", F.ceil("__qpos"))

    def holds(rank: str, start: Column, size: Column) -> Column:
        return (start <= F.col(rank)) & (F.col(rank) < start + size)
    wanted = ranges.filter(holds("__qlo", F.col("__qb"), F.col("__qm")) | holds("__qhi", F.col("__qb"), F.col("__qm"))) \
        .select(*keys, "__qr", "__qb", "__qpos", "__qlo", "__qhi")
    within = Window.partitionBy(*keys, "__qr").orderBy("__qv").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.join(wanted, [*keys, "__qr"]).withColumn("__qs", F.col("__qb") + F.sum("__qn").over(within) - F.col("__qn"))
    lo, hi = (holds(r, F.col("__qs"), F.col("__qn")) for r in ("__qlo", "__qhi"))
    picked = run.filter(lo | hi).groupBy(*keys).agg(F.max(F.when(lo, F.col("__qv"))).alias("__qvlo"), F.max(F.when(hi, F.col("__qv"))).alias("__qvhi"),
                                                    F.first("__qpos").alias("__qpos"))
    frac = F.col("__qpos") - F.floor("__qpos")
    return picked.select(*keys, (F.col("__qvlo") + (F.col("__qvhi") - F.col("__qvlo")) * frac).alias(alias))


def max_by_key(df: DataFrame, key: str, value: str, alias: str = "max_value") -> DataFrame:
    """AGG-11: max by key."""
    return df.groupBy(key).agg(F.max(value).alias(alias))


def pivot_sum(df: DataFrame, row: str, col: str, value: str, values: Sequence | None = None) -> DataFrame:
    """AGG-13: pivot with sum, missing cells 0.  Pass ``values`` to skip the
    distinct-values pre-pass on large data."""
    g = df.groupBy(row)
    p = g.pivot(col, list(values)) if values is not None else g.pivot(col)
    return p.agg(F.sum(value)).fillna(0)


def crosstab_long(df: DataFrame, a: str, b: str, alias: str = "n") -> DataFrame:
    """AGG-17 in long form: counts per (a, b) over rows where both are non-null.

    The zero cells of the wide table are implicit (pivot with ``pivot_sum``
    when a wide table is wanted).
    """
    return df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias(alias))


def leave_one_out_means(df: DataFrame, key: str, values: Sequence[str], min_rows: int = 2,
                        suffix: str = "_loo") -> DataFrame:
    """AGG-18 / WIN-04 / FIL-06: per-row mean of the *other* rows of its group.

    Rows with a null in the key or a value are dropped first; groups with
    fewer than ``min_rows`` rows are removed.  Group sums and counts are
    aggregated (partial aggregation before the shuffle) and joined back.
    """
    clean = df.dropna(subset=[key, *values])
    stats = clean.groupBy(key).agg(F.count(F.lit(1)).alias("__n"),
                                   *[F.sum(v).alias(f"__s_{v}") for v in values])
    stats = stats.filter(F.col("__n") >= min_rows)
    joined = clean.join(stats, key, "inner")
    out = joined.select(*clean.columns, *[((F.col(f"__s_{v}") - F.col(v)) / (F.col("__n") - 1)).alias(f"{v}{suffix}")
                                          for v in values])
    return out


def correlation_long(df: DataFrame, left: Sequence[str], right: Sequence[str],
                     names=("row_var", "col_var", "r")) -> DataFrame:
    """AGG-19 / STAT-11: Pearson r for every (left, right) pair in ONE aggregate.

    Output is long (row variable, column variable, r); the p x q result is the
    only thing that is ever small.
    """
    pairs = [(a, b) for a in left for b in right]
    row = df.agg(*[F.corr(a, b).alias(f"__r{i}") for i, (a, b) in enumerate(pairs)])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias(names[0]), F.lit(b).alias(names[1]),
                                           F.col(f"__r{i}").alias(names[2]))
                                  for i, (a, b) in enumerate(pairs)]))
    return row.select(stacked.alias("__x")).select("__x.*")


def distinct_text(df: DataFrame, key: str, value: str, alias: str, sep: str = " ") -> DataFrame:
    """AGG-21: ``string_agg(DISTINCT x, ' ')`` per key, deterministic (sorted)."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(alias))


def duplicate_flag(df: DataFrame, col: str, alias: str = "is_duplicate") -> DataFrame:
    """AGG-28 / VAL-10: every copy of a repeated value flagged (nulls are copies).

    Counts per value are pre-aggregated and joined back with a null-safe
    equality, so a hot value never lands in one window partition.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("__dup_n"))
    c2 = counts.withColumnRenamed(col, "__dup_v")
    joined = df.join(c2, df[col].eqNullSafe(c2["__dup_v"]), "left")
    return joined.withColumn(alias, F.col("__dup_n") > 1).drop("__dup_v", "__dup_n")


def mean_by_position(df: DataFrame, group: str, position: str, value: str, first_n: int = 50,
                     max_position: int = 50, tie_cols: Sequence[str] = ()) -> DataFrame:
    """CH-07 / WIN-02 / AGG-29 / FIL-04: first ``first_n`` rows per group in
    position order, then the mean value per position ≤ ``max_position``.

    The ``row_number() <= n`` filter becomes a partial WindowGroupLimit before
    the shuffle, so a hot group ships at most n rows per map task.
    """
    clean = df.select(group, position, value, *tie_cols).dropna(subset=[group, position, value])
    w = Window.partitionBy(group).orderBy(F.col(position), F.col(value), *[F.col(c) for c in tie_cols])
    head = clean.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= first_n)
    return (head.filter(F.col(position) <= max_position).groupBy(position)
            .agg(F.avg(value).alias(f"avg_{value}")))


def first_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """WIN-02 / TOP-04 (per group): ``groupby.head(n)`` after a sort."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def share_of_group_total(value: str | Column, group: Sequence[str]) -> Column:
    """AGG-16: 100·v / group total, null when the total is 0 (post-aggregation)."""
    v = _c(value)
    return 100.0 * v / F.nullif(F.sum(v).over(Window.partitionBy(*group)), F.lit(0))


def rolling_mean(value: str, partition: Sequence[str], order: str, window: int) -> Column:
    """WIN-03: trailing mean over ``window`` rows, nulls ignored (min_periods=1)."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(window - 1), 0)
    return F.avg(F.col(value)).over(w)


def cumulative_sum(value: str, order: str) -> Column:
    """WIN-05: running total (used on p-row statistic frames only)."""
    return F.sum(value).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


# ------------------------------------------------------------ set operations

def tagged_union(parts: Sequence[tuple[str, DataFrame]], tag_col: str = "entity_type") -> DataFrame:
    """SET-01: ``UNION ALL`` with a discriminator column."""
    out = None
    for tag, frame in parts:
        f = frame.withColumn(tag_col, F.lit(tag))
        out = f if out is None else out.unionByName(f)
    return out


def set_union(*frames: DataFrame) -> DataFrame:
    """SET-02: union then DISTINCT."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()
