"""Popularity regression (REG-01 … REG-07).

Feature preparation is expressions plus ONE statistics pass (medians by
histogram refinement, means / stds by one aggregate); the statistics are a
small driver-side record (the fitted "preprocess meta") reused verbatim on
new rows.  The model is linear with the Smooth-L1 loss, fitted by passes of one
aggregate each (or MLlib's Huber regression, which also fits a scale); the split
is a stable hash, reproducible under any partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import add
from typing import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import stable_split
from .quantiles import exact_quantiles, literal
from .stats import moments


@dataclass
class PrepMeta:
    """REG-02/03: fitted feature statistics (a few numbers per feature)."""
    features: list[str]
    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    target_min: float | None = None
    target_max: float | None = None


def latest_rank_frame(entity: DataFrame, key: str, ranks: DataFrame, order_col: str, rank_cols: Sequence[str],
                      tie_cols: Sequence[str] = ()) -> DataFrame:
    """REG-01 / JOIN-09: entity columns + the latest rank row (``rn = 1``)."""
    w = Window.partitionBy(key).orderBy(F.desc(order_col), *[F.desc(c) for c in tie_cols])
    latest = (ranks.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
              .select(key, *rank_cols))
    return entity.join(latest, key, "left")


def _finite(c) -> F.Column:
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def fit_prep(df: DataFrame, features: Sequence[str], target: str | None = None) -> PrepMeta:
    """Fit medians, means and stds (ddof 1) of the finite, median-filled features."""
    finite = df.select(*[_finite(F.col(c)).alias(c) for c in features],
                       *([F.log1p(F.greatest(F.col(target).try_cast("double"), F.lit(0.0))).alias("__y")] if target else []))
    med = exact_quantiles(finite, list(features), 0.5)
    filled = finite.select(*[F.coalesce(F.col(c), literal(med[c])).alias(c) for c in features],
                           *(["__y"] if target else []))
    mean, sd = moments(filled, list(features), ddof=1)
    meta = PrepMeta(list(features), med, mean, sd)
    if target:
        r = filled.agg(F.min("__y"), F.max("__y")).collect()[0]
        meta.target_min, meta.target_max = r[0], r[1]
    return meta


def apply_prep(df: DataFrame, meta: PrepMeta, keep: Sequence[str] = (), target: str | None = None) -> DataFrame:
    """REG-02/03: inf → null, median fill (absent columns get the median),
    z-score (std 0 ⇒ 1), residual non-finite → 0; target → log1p(max(y, 0))."""
    out = []
    for c in meta.features:
        src = _finite(F.col(c)) if c in df.columns else F.lit(None).cast("double")
        med = literal(meta.medians.get(c))
        sd = meta.stds.get(c)
        scale = 1.0 if sd is None or sd == 0 or (isinstance(sd, float) and math.isnan(sd)) else sd
        z = (F.coalesce(src, med) - literal(meta.means.get(c))) / F.lit(scale)
        out.append(F.coalesce(_finite(z), F.lit(0.0)).alias(c))
    extra = []
    if target and target in df.columns:
        y = F.log1p(F.greatest(F.col(target).try_cast("double"), F.lit(0.0)))
        extra.append(F.coalesce(_finite(y), F.lit(0.0)).alias("label"))
    return df.select(*keep, *out, *extra)


def split(df: DataFrame, key: str, seed: int = 1234, train: float = 0.8, test: float = 0.2,
          validation_of_train: float = 0.1) -> DataFrame:
    """REG-04: 80/20 then 10 % of train as validation, by a stable hash."""
    tr = train * (1 - validation_of_train)
    return df.withColumn("split", stable_split(F.col(key), seed,
                                               {"train": tr, "validation": train - tr, "test": test}))


def fit(train_df: DataFrame, features: Sequence[str], *, epsilon: float = 1.35, reg: float = 0.0,
        max_iter: int = 100):
    """REG-05: robust (Huber) linear regression on the prepared features."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(train_df)
    lr = LinearRegression(featuresCol="features", labelCol="label", loss="huber", epsilon=epsilon,
                          regParam=reg, maxIter=max_iter)
    # The optimiser makes one pass per iteration: keep the assembled rows
    # (spilling to disk) rather than re-running their lineage every pass.
    assembled = assembled.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return lr.fit(assembled)
    finally:
        assembled.unpersist()


@dataclass
class LinearFit:
    """Coefficients of a linear model of the prepared features, with what fitting them took."""
    features: list[str]
    coefficients: list[float]
    intercept: float
    loss: float = math.nan
    passes: int = 0

    def prediction(self) -> Column:
        return reduce(add, [F.col(f) * F.lit(float(c)) for f, c in zip(self.features, self.coefficients)], F.lit(float(self.intercept)))


def smooth_l1(error: Column) -> Column:
    """0.5 e² within 1, |e| − 0.5 beyond."""
    size = F.abs(error)
    return F.when(size < 1.0, 0.5 * error * error).otherwise(size - 0.5)


def fit_smooth_l1(train: DataFrame, features: Sequence[str], *, label: str = "label", tolerance: float = 1e-8,
                  max_passes: int = 100) -> LinearFit:
    """REG-05: the linear model of least mean Smooth-L1 loss, over all rows in every pass.

    With weights min(1, 1/|e|) of the last errors the loss lies under a weighted
    sum of squares that touches it there, so the weighted least-squares solution
    never raises it.  A pass is ONE aggregate of the p(p+3)/2 weighted sums, added
    up within tasks before anything is shuffled; the driver solves p + 1 equations.
    It ends once no coefficient moves by more than ``tolerance``, or after
    ``max_passes``.  Rows with a null label or feature are left out.
    """
    names = [*features, "__one"]
    rows = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("__y")).dropna() \
        .withColumn("__one", F.lit(1.0)).persist(StorageLevel.MEMORY_AND_DISK)
    p = len(names)
    try:
        beta, passes, loss = np.zeros(p), 0, math.nan
        while passes < max_passes:
            error = F.col("__y") - reduce(add, [F.col(n) * F.lit(float(b)) for n, b in zip(names, beta)])
            # the first pass is plain least squares
            weighed = rows.withColumn("__e", error).withColumn("__w", F.lit(1.0) if passes == 0 else F.lit(1.0) / F.greatest(F.lit(1.0), F.abs("__e")))
            sums = weighed.agg(*[F.sum(F.col("__w") * F.col(names[i]) * F.col(names[j])).alias(f"a{i}_{j}") for i in range(p) for j in range(i, p)],
                               *[F.sum(F.col("__w") * F.col(n) * F.col("__y")).alias(f"b{i}") for i, n in enumerate(names)],
                               F.avg(smooth_l1(F.col("__e"))).alias("loss"), F.count("*").alias("n")).first()
            if not sums["n"]:
                raise ValueError("no complete row to fit")
            a = np.array([[sums[f"a{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
            after = np.linalg.lstsq(a, np.array([sums[f"b{i}"] for i in range(p)]), rcond=None)[0]
            moved = float(np.abs(after - beta).max())
            beta, passes, loss = after, passes + 1, sums["loss"]
            if passes > 1 and moved <= tolerance:
                break
        fit = LinearFit(list(features), [float(b) for b in beta[:-1]], float(beta[-1]), passes=passes)
        fit.loss = rows.agg(F.avg(smooth_l1(F.col("__y") - fit.prediction()))).first()[0]
        return fit
    finally:
        rows.unpersist()


def predict_linear(fit: LinearFit, df: DataFrame, target_min: float, target_max: float, keep: Sequence[str] = ()) -> DataFrame:
    """REG-06 for :class:`LinearFit`: clip the log prediction to the training range, then expm1."""
    clipped = F.least(F.greatest(fit.prediction(), literal(target_min)), literal(target_max))
    return df.select(*keep, *(["label"] if "label" in df.columns else []), clipped.alias("pred_log"), F.expm1(clipped).alias("predicted"))


def predict(model, df: DataFrame, features: Sequence[str], meta: PrepMeta, keep: Sequence[str] = ()) -> DataFrame:
    """REG-06: clip the log prediction to the training range, then expm1."""
    from pyspark.ml.feature import VectorAssembler
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    pred = model.transform(assembled)
    clipped = F.least(F.greatest(F.col("prediction"), literal(meta.target_min)), literal(meta.target_max))
    return pred.select(*keep, *(["label"] if "label" in df.columns else []),
                       clipped.alias("pred_log"), F.expm1(clipped).alias("predicted"))


def evaluate(pred: DataFrame) -> DataFrame:
    """REG-07 / AGG-33: RMSE, MAE, R² on the log and the natural scale, ONE aggregate."""
    rows = []
    for scale, y, p in (("log", F.col("label"), F.col("pred_log")),
                        ("natural", F.expm1("label"), F.col("predicted"))):
        e = y - p
        rows.append(F.struct(F.lit(scale).alias("scale"), F.sqrt(F.avg(e * e)).alias("rmse"),
                             F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"), F.sum(y).alias("sy"),
                             F.sum(y * y).alias("syy"), F.count(F.lit(1)).alias("n")))
    agg = pred.agg(F.array(*rows).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return agg.select("scale", "rmse", "mae", F.when(sst > 0, F.lit(1.0) - F.col("sse") / sst).alias("r2"))


def listens_model(frame: DataFrame, key: str, features: Sequence[str], target: str, seed: int = 1234, loss: str = "smooth_l1"):
    """End to end: split, fit stats on train, prepare, fit (``smooth_l1`` or MLlib's ``huber``), predict every split."""
    if loss not in ("smooth_l1", "huber"):
        raise ValueError(loss)
    parts = split(frame, key, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_raw = parts.filter(F.col("split") == "train")
        meta = fit_prep(train_raw, features, target)
        prepared = apply_prep(parts, meta, keep=[key, "split"], target=target).filter(F.col("split") == "train")
        model = fit(prepared, features) if loss == "huber" else fit_smooth_l1(prepared, features)
    finally:
        parts.unpersist()
    rows = apply_prep(split(frame, key, seed), meta, keep=[key, "split"], target=target)
    if loss == "huber":
        return meta, model, predict(model, rows, features, meta, keep=[key, "split"])
    return meta, model, predict_linear(model, rows, meta.target_min, meta.target_max, keep=[key, "split"])
