"""Exact global quantiles at any scale, by histogram refinement.

``F.median`` / ``percentile`` keep every distinct value of a column in one
aggregation buffer; on a 100 TB column that is unbounded.  Here each pass is
one aggregate over (target, bucket) counts -- map-side combined, memory
O(bins) per task -- that narrows the interval holding a wanted rank by a
factor ``bins``, until it is a single value.  A pass takes at least one value
out of an interval, and its width is divided by ``bins``, so a few passes
do for any data and a double's exponent range bounds them.  No value list ever
reaches the driver.  Columns are handled together (one scan per pass); skew
is harmless because a hot value just ends in a zero-width interval.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class _Target:
    """The value of rank ``rank`` of column ``col`` lies in [lo, hi]; ``below`` values lie under lo."""
    col: int
    rank: int
    lo: float
    hi: float
    below: int = 0

    def bucket(self, bins: int) -> Column:
        v = F.col("v")
        if math.isinf(self.lo) or math.isinf(self.hi):
            return F.when(v == F.lit(float("-inf")), 0).when(v == F.lit(float("inf")), 2).otherwise(1)
        width = self.hi / bins - self.lo / bins                # no overflow at the ends of the range
        if width <= 0 or self.hi / width - self.lo / width < 1:         # neighbours in double precision
            return F.when(v > F.lit(self.lo), 1).otherwise(0)
        return F.least(F.floor(v / F.lit(width) - F.lit(self.lo / width)), F.lit(bins - 1)).cast("int")

    def narrow(self, buckets) -> None:
        """``buckets``: (bucket, count, min, max) rows."""
        for _, n, least, most in sorted(buckets):
            if self.rank < self.below + n:
                self.lo, self.hi = least, most
                return
            self.below += n


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float | Sequence[float] = 0.5, bins: int = 4096) -> dict:
    """Linearly interpolated ``q``-quantile of each column (NULL/NaN ignored): {column: value}, or
    {column: [values]} for several ``q``, which are found together."""
    several = not isinstance(q, (int, float))
    stacked = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
                                             for i, c in enumerate(cols)])).alias("s"))
               .select("s.i", "s.v").filter(F.col("v").isNotNull() & ~F.isnan("v")))
    # Every pass re-reads the same narrow (column, value) frame: keep it
    # (memory, spilling to disk) instead of re-running the input's lineage.
    stacked = stacked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _refine(stacked, cols, list(q) if several else [q], bins)
    finally:
        stacked.unpersist()
    return found if several else {c: v[0] for c, v in found.items()}


def _refine(stacked: DataFrame, cols: Sequence[str], qs: Sequence[float], bins: int) -> dict[str, list[float | None]]:
    first = {r["i"]: r for r in stacked.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                                                         F.max("v").alias("hi")).collect()}
    places = {i: [(r["n"] - 1) * q for q in qs] for i, r in first.items()}
    targets = {(i, k): _Target(i, k, first[i]["lo"], first[i]["hi"]) for i, ps in places.items() for p in ps
               for k in (math.floor(p), math.ceil(p))}
    while wide := [(t, target) for t, target in enumerate(targets.values()) if target.lo < target.hi]:
        # a row meets the open targets of its own column only
        hits = None
        for col in sorted({target.col for _, target in wide}):
            own = F.array(*[F.when(F.col("v").between(target.lo, target.hi), F.struct(F.lit(t).alias("t"), target.bucket(bins).alias("b")))
                            for t, target in wide if target.col == col])
            hits = F.when(F.col("i") == col, own) if hits is None else hits.when(F.col("i") == col, own)
        counts = (stacked.select("v", F.explode(hits).alias("h")).filter("h is not null").groupBy("h.t", "h.b")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        for t, target in wide:
            target.narrow([(r["b"], r["n"], r["lo"], r["hi"]) for r in counts if r["t"] == t])
    result: dict[str, list[float | None]] = {c: [None] * len(qs) for c in cols}
    for i, ps in places.items():
        for at, p in enumerate(ps):
            low, high = targets[i, math.floor(p)].lo, targets[i, math.ceil(p)].lo
            result[cols[i]][at] = low if low == high else low + (high - low) * (p - math.floor(p))
    return result


def exact_median(df: DataFrame, col: str, **kw) -> float | None:
    return exact_quantiles(df, [col], 0.5, **kw)[col]


def literal(v) -> Column:
    return F.lit(None).cast("double") if v is None else F.lit(float(v))
