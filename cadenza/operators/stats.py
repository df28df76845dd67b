"""Multivariate statistics (STAT-01 … STAT-11).

Spark does the data-sized work in ONE aggregate per matrix (all pairwise
correlations or co-moments in a single ``agg``); only the p x p matrix and
p-length vectors reach the driver, where numpy handles eigen-decompositions,
subset search, rotations and the Bartlett p-value.  Per-row outputs
(standardised values, PCA coordinates) are Spark expressions with the p x k
loadings inlined as literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import top_labels
from .quantiles import exact_quantiles, literal


# ------------------------------------------------------------ Spark side

def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of several columns (histogram refinement, bounded memory)."""
    return exact_quantiles(df, cols, 0.5)


def moments(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> tuple[dict, dict]:
    """Means and standard deviations of several columns in ONE job."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[sd(c).alias(f"s_{i}") for i, c in enumerate(cols)]).collect()[0]
    return ({c: row[f"m_{i}"] for i, c in enumerate(cols)}, {c: row[f"s_{i}"] for i, c in enumerate(cols)})


def _scale(s) -> float:
    return 1.0 if s is None or s == 0 or (isinstance(s, float) and math.isnan(s)) else float(s)


def _number(c: str):
    """A column as a number; bad text and NaN are missing."""
    return F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double"))


def impute_median(df: DataFrame, cols: Sequence[str], medians: dict | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Median imputation only (enough for correlations: they ignore scale)."""
    med = medians if medians is not None else column_medians(df, cols)
    return df.select(*keep, *[F.coalesce(_number(c), literal(med[c])).alias(c) for c in cols])


def impute_standardise(df: DataFrame, cols: Sequence[str], ddof: int = 0, keep: Sequence[str] = (),
                       medians: dict | None = None) -> DataFrame:
    """STAT-01 / REG-02: median imputation then z-score (ddof 0 or 1).

    Two small jobs bring 3p numbers to the driver (medians; means and stds
    of the imputed columns); the per-row work is one projection with them
    as literals."""
    med = medians if medians is not None else column_medians(df, cols)
    filled = df.select(*keep, *[F.coalesce(_number(c), literal(med[c])).alias(c) for c in cols])
    mean, sd = moments(filled, cols, ddof)
    return filled.select(*keep, *[((F.col(c) - literal(mean[c])) / F.lit(_scale(sd[c]))).alias(c) for c in cols])


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, int]:
    """AGG-19/20: Pearson matrix from ONE aggregate; returns (R, n rows)."""
    p = len(cols)
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.corr(cols[i], cols[j]).alias(f"r{i}_{j}") for i, j in pairs]).collect()[0]
    R = np.eye(p)
    for i, j in pairs:
        v = row[f"r{i}_{j}"]
        R[i, j] = R[j, i] = np.nan if v is None else v
    return R, int(row["__n"])


def covariance_matrix(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> tuple[np.ndarray, int]:
    """Co-moment matrix from ONE aggregate (population or sample)."""
    p = len(cols)
    fn = F.covar_pop if ddof == 0 else F.covar_samp
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[fn(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]
    C = np.zeros((p, p))
    for i, j in pairs:
        C[i, j] = C[j, i] = row[f"c{i}_{j}"] or 0.0
    return C, int(row["__n"])


def corr_long(spark: SparkSession, R: np.ndarray, names: Sequence[str]) -> DataFrame:
    rows = [(names[i], names[j], float(R[i, j])) for i in range(len(names)) for j in range(len(names))]
    return spark.createDataFrame(rows, "var_i string, var_j string, r double")


# ----------------------------------------------------------- driver side (p x p)

@dataclass
class PcaResult:
    names: list[str]
    eigenvalues: np.ndarray        # explained_variance (n − 1 denominator)
    ratios: np.ndarray
    loadings: np.ndarray           # p x k, columns = dimensions, sign fixed


def mean_abs_offdiag(R: np.ndarray) -> np.ndarray:
    """AGG-20: mean off-diagonal |r| per column."""
    A = np.abs(R.copy())
    np.fill_diagonal(A, np.nan)
    return np.nanmean(A, axis=0)


def pca_from_corr(R: np.ndarray, n: int, names: Sequence[str], max_components: int = 10) -> PcaResult:
    """STAT-03/04/05: PCA of z-scored (ddof 0) data = eigen of R; eigenvalues
    reported as λ·n/(n−1) like the source application's explained variance."""
    w, V = np.linalg.eigh(R)
    order = np.argsort(w)[::-1]
    w, V = w[order], V[:, order]
    k = min(max_components, len(names))
    w, V = w[:k], V[:, :k]
    for j in range(k):                              # sign: largest |loading| positive
        if V[np.argmax(np.abs(V[:, j])), j] < 0:
            V[:, j] = -V[:, j]
    total = np.trace(R)
    ev = w * n / (n - 1) if n > 1 else w
    return PcaResult(list(names), ev, w / total, V)


def subset_search(R: np.ndarray, n: int, names: Sequence[str], min_cols: int = 4,
                  target: float = 0.5) -> tuple[list[str], PcaResult]:
    """STAT-02: drop all-null columns; while ≥ ``min_cols`` columns, stop when
    Dim1+Dim2 ≥ target, else drop the column with the least mean |r|; keep
    the best subset seen.  Every step is a sub-matrix of the ONE R."""
    keep = [i for i in range(len(names)) if not np.all(np.isnan(np.delete(R[i], i)))]
    best = None
    while len(keep) >= min_cols:
        sub = np.nan_to_num(R[np.ix_(keep, keep)])
        res = pca_from_corr(sub, n, [names[i] for i in keep])
        score = float(res.ratios[:2].sum())
        if best is None or score > best[0]:
            best = (score, [names[i] for i in keep], res)
        if score >= target:
            break
        drop = int(np.argmin(mean_abs_offdiag(sub)))
        keep.pop(drop)
    if best is None:
        sub = np.nan_to_num(R[np.ix_(keep, keep)])
        res = pca_from_corr(sub, n, [names[i] for i in keep])
        return [names[i] for i in keep], res
    return best[1], best[2]


def drop_path(R: np.ndarray, names: Sequence[str], min_cols: int = 4) -> list[tuple[str, float]]:
    """STAT-02: the columns in the order in which the subset search would drop them, each with its
    mean |r| to the columns still there, while at least ``min_cols`` are left."""
    keep = [i for i in range(len(names)) if not np.all(np.isnan(np.delete(R[i], i)))]
    out = []
    while len(keep) >= min_cols:
        means = mean_abs_offdiag(np.nan_to_num(R[np.ix_(keep, keep)]))
        at = int(np.argmin(means))
        out.append((names[keep[at]], float(means[at])))
        keep.pop(at)
    return out


def variance_table(spark: SparkSession, res: PcaResult) -> DataFrame:
    """STAT-04 / WIN-05: eigenvalue, % and cumulative % per dimension."""
    cum = np.cumsum(res.ratios)
    rows = [(f"Dim{i + 1}", i + 1, float(res.eigenvalues[i]), float(res.ratios[i] * 100), float(cum[i] * 100))
            for i in range(len(res.ratios))]
    return spark.createDataFrame(rows, "dimension string, dim int, eigenvalue double, pct_variance double, "
                                       "pct_cumulative double")


def loadings_table(spark: SparkSession, res: PcaResult) -> DataFrame:
    """STAT-05: variables x dimensions, long form."""
    rows = [(res.names[i], f"Dim{j + 1}", float(res.loadings[i, j]))
            for i in range(len(res.names)) for j in range(res.loadings.shape[1])]
    return spark.createDataFrame(rows, "variable string, dimension string, loading double")


def top_loadings(spark: SparkSession, res: PcaResult, k: int = 30) -> DataFrame:
    """TOP-08: the ``k`` variables with the longest (Dim1, Dim2) loading vector."""
    if res.loadings.shape[1] < 2:
        raise ValueError("need at least two dimensions")
    strength = np.sqrt(res.loadings[:, 0] ** 2 + res.loadings[:, 1] ** 2)
    order = sorted(range(len(res.names)), key=lambda i: (-strength[i], res.names[i]))[:k]
    rows = [(res.names[i], float(res.loadings[i, 0]), float(res.loadings[i, 1]), float(strength[i]), r + 1)
            for r, i in enumerate(order)]
    return spark.createDataFrame(rows, "variable string, dim1 double, dim2 double, strength double, rank int")


def coordinates(z: DataFrame, res: PcaResult, key: str, label: str | None = None, top_labels_n: int = 12,
                other: str = "Autre", dims: int = 2) -> DataFrame:
    """STAT-06 / TOP-08: Dim1/Dim2 per row (dot products with literal
    loadings); labels outside the top ``top_labels_n`` become ``other``."""
    cols = [sum((F.col(res.names[i]) * float(res.loadings[i, j]) for i in range(len(res.names))), F.lit(0.0))
            .alias(f"Dim{j + 1}") for j in range(min(dims, res.loadings.shape[1]))]
    out = z.select(key, *([label] if label else []), *cols)
    if label:
        counts = out.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
        head = top_labels(counts, label, "__n", top_labels_n).withColumn("__top", F.lit(True))
        out = (out.join(F.broadcast(head), label, "left")
               .withColumn(label, F.when(F.col("__top"), F.col(label)).otherwise(F.lit(other))).drop("__top"))
    return out


def _gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        s, term, ap = 1.0 / a, 1.0 / a, a
        for _ in range(10000):
            ap += 1.0
            term *= x / ap
            s += term
            if abs(term) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b = x + 1.0 - a
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def bartlett_sphericity(R: np.ndarray, n: int) -> tuple[float, float, int]:
    """STAT-08: χ² = −(n − 1 − (2p + 5)/6)·ln det R, df = p(p − 1)/2, p-value."""
    p = R.shape[0]
    det = float(np.linalg.det(R))
    chi2 = -(n - 1 - (2 * p + 5) / 6.0) * math.log(det) if det > 0 else float("inf")
    df = p * (p - 1) // 2
    pval = 0.0 if math.isinf(chi2) else _gammaincc(df / 2.0, chi2 / 2.0)
    return chi2, pval, df


def kaiser_count(R: np.ndarray) -> tuple[int, np.ndarray]:
    """STAT-09: number of eigenvalues of R above 1."""
    ev = np.sort(np.linalg.eigvalsh(R))[::-1]
    return int((ev > 1).sum()), ev


def _orthomax(L: np.ndarray, gamma: float, iters: int = 100, tol: float = 1e-6) -> np.ndarray:
    p, k = L.shape
    Rm = np.eye(k)
    var = 0.0
    for _ in range(iters):
        Lr = L @ Rm
        u, s, vt = np.linalg.svd(L.T @ (Lr ** 3 - (gamma / p) * Lr @ np.diag(np.sum(Lr ** 2, axis=0))))
        Rm = u @ vt
        new = float(np.sum(s))
        if var != 0 and new < var * (1 + tol):
            break
        var = new
    return L @ Rm


def factor_analysis(C: np.ndarray, n_factors: int, rotation: str | None = None, max_iter: int = 1000,
                    tol: float = 1e-2) -> np.ndarray:
    """STAT-10: maximum-likelihood factor loadings (p x k) from the ddof-0
    covariance, by the alternating eigen / uniqueness iteration, then an
    optional varimax or quartimax rotation."""
    p = C.shape[0]
    var = np.diag(C).copy()
    psi = np.ones(p)
    small = 1e-12
    old_ll = -np.inf
    W = np.zeros((n_factors, p))
    for _ in range(max_iter):
        sp = np.sqrt(psi) + small
        M = C / np.outer(sp, sp)
        w, V = np.linalg.eigh(M)
        order = np.argsort(w)[::-1]
        w, V = w[order], V[:, order]
        s = w[:n_factors]
        W = (np.sqrt(np.maximum(s - 1.0, 0.0))[:, None] * V[:, :n_factors].T) * sp
        ll = -0.5 * (np.sum(np.log(np.maximum(s, small))) + np.sum(w[n_factors:]) + np.sum(np.log(psi)))
        psi = np.maximum(var - np.sum(W ** 2, axis=0), small)
        if ll - old_ll < tol:
            break
        old_ll = ll
    L = W.T
    if rotation == "varimax":
        L = _orthomax(L, 1.0)
    elif rotation == "quartimax":
        L = _orthomax(L, 0.0)
    elif rotation is not None:
        raise ValueError(rotation)
    return L


def orthomax_criterion(L: np.ndarray, gamma: float) -> float:
    """What a rotation makes as large as it can: varimax for 1, quartimax for 0."""
    return float(np.sum(L ** 4) - gamma / len(L) * np.sum(np.sum(L ** 2, axis=0) ** 2))


@dataclass
class FactorFlow:
    bartlett: dict                 # table -> (chi2, p_value, dof)
    relevant: bool
    n_factors: int
    eigenvalues: np.ndarray
    loadings: dict                 # rotation -> p x k loadings


def factor_flow(table: DataFrame, cols: Sequence[str], cut: float = 0.5,
                rotations: Sequence[str | None] = (None, "varimax", "quartimax")) -> FactorFlow:
    """STAT-07 … STAT-10 as one flow over a contingency table's columns:
    Bartlett on the raw and the column-standardised table; stop when either
    p-value exceeds ``cut`` (Q-21, 0.5 as in the source application);
    else Kaiser's factor count and ML factor loadings per rotation.  Spark
    computes the two correlation matrices and one covariance matrix."""
    R, n = correlation_matrix(table, cols)
    z = standardise_columns(table, cols)
    Rz, nz = correlation_matrix(z, cols)
    raw, std = bartlett_sphericity(R, n), bartlett_sphericity(Rz, nz)
    tests = {"raw": raw, "standardised": std}
    if raw[1] > cut or std[1] > cut:
        return FactorFlow(tests, False, 0, np.array([]), {})
    k, ev = kaiser_count(Rz)
    C, _ = covariance_matrix(z, cols, ddof=0)
    loads = {(rot or "none"): factor_analysis(C, max(k, 1), rot) for rot in rotations}
    return FactorFlow(tests, True, k, ev, loads)


def standardise_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """STAT-07: column z-score with ddof 1 (pandas ``(x − mean)/std``)."""
    mean, sd = moments(df, cols, ddof=1)
    return df.select(*keep, *[((F.col(c) - literal(mean[c])) / literal(sd[c])).alias(c) for c in cols])


def small_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
