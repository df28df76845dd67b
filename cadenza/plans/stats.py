"""Statistics queries (STAT-*, AGG-19/20) on the driver tables.

Input block: lineitem numerics joined to part (p_size, p_retailprice), with
nulls injected deterministically into l_discount (l_orderkey % 7 = 0) so the
median imputation does work.  Contingency analysis: nation x order priority.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import stats as S
from .common import T, rnd
from .registry import query

PCA_VARS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice"]


ID_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _pca_columns(block):
    """PRJ-07: numeric columns by type minus identifiers, in the preferred order."""
    from ..sources.columns import numeric_columns
    return numeric_columns(block, exclude=ID_COLUMNS, preferred=PCA_VARS)


def _block(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag",
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"))
    p = T(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    return li.join(p, "l_partkey", "left")


_IMPUTED_SQL = f"""
WITH b AS (
  SELECT l.l_quantity, l.l_extendedprice, CASE WHEN l.l_orderkey % 7 = 0 THEN NULL ELSE l.l_discount END AS l_discount,
         l.l_tax, CAST(p.p_size AS DOUBLE) AS p_size, p.p_retailprice
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
), m AS (SELECT {', '.join(f'median({c}) AS {c}' for c in PCA_VARS)} FROM b),
z AS (SELECT {', '.join(f'coalesce(b.{c}, m.{c}) AS {c}' for c in PCA_VARS)} FROM b CROSS JOIN m)
"""


def _corr_sql():
    rows = []
    for i, a in enumerate(PCA_VARS):
        for j, c in enumerate(PCA_VARS):
            r = "max(1.0)" if i == j else f"corr({a}, {c})"
            rows.append(f"SELECT '{a}' AS var_i, '{c}' AS var_j, round({r}, 6) AS r FROM z")
    return _IMPUTED_SQL + "\nUNION ALL ".join(rows)


def _corr(spark, sf_dir, with_medians: bool = False):
    """Medians (histogram refinement), moments, then all pairwise
    correlations in one aggregate; the medians are returned for reuse."""
    full = _block(spark, sf_dir)
    cols = _pca_columns(full)
    block = full.select(*cols)
    med = S.column_medians(block, cols)
    R, n = S.correlation_matrix(S.impute_median(block, cols, med), cols)   # r ignores scaling
    return (R, n, med) if with_medians else (R, n)


@query("pca_correlation", ("STAT-01", "AGG-19", "PRJ-07"), _corr_sql())
def pca_correlation(spark, sf_dir):
    R, _ = _corr(spark, sf_dir)
    return S.corr_long(spark, R, PCA_VARS).select("var_i", "var_j", rnd("r").alias("r"))


def _mean_abs_sql():
    parts = []
    for a in PCA_VARS:
        terms = " + ".join(f"abs(corr({a}, {c}))" for c in PCA_VARS if c != a)
        parts.append(f"SELECT '{a}' AS variable, round(({terms}) / {len(PCA_VARS) - 1}.0, 6) AS mean_abs_r FROM z")
    return _IMPUTED_SQL + "\nUNION ALL ".join(parts)


@query("mean_abs_corr", ("AGG-20",), _mean_abs_sql())
def mean_abs_corr(spark, sf_dir):
    R, _ = _corr(spark, sf_dir)
    m = S.mean_abs_offdiag(R)
    return spark.createDataFrame([(v, float(x)) for v, x in zip(PCA_VARS, m)], "variable string, mean_abs_r double") \
        .select("variable", rnd("mean_abs_r").alias("mean_abs_r"))


def _pca(spark, sf_dir, with_medians: bool = False):
    R, n, med = _corr(spark, sf_dir, with_medians=True)
    names, res = S.subset_search(R, n, PCA_VARS, min_cols=4, target=0.5)
    return (names, res, med) if with_medians else (names, res)


@query("pca_variance", ("STAT-02", "STAT-03", "STAT-04", "WIN-05", "SRC-16"))
def pca_variance(spark, sf_dir):
    _, res = _pca(spark, sf_dir)
    v = S.variance_table(spark, res)
    return v.select("dimension", rnd("eigenvalue").alias("eigenvalue"), F.round("pct_variance", 2).alias("pct_variance"),
                    F.round("pct_cumulative", 2).alias("pct_cumulative"))


@query("pca_loadings", ("STAT-05",))
def pca_loadings(spark, sf_dir):
    _, res = _pca(spark, sf_dir)
    return S.loadings_table(spark, res).select("variable", "dimension", rnd("loading").alias("loading"))


@query("pca_top_loadings", ("TOP-08", "STAT-05"))
def pca_top_loadings(spark, sf_dir):
    _, res = _pca(spark, sf_dir)
    t = S.top_loadings(spark, res, k=30)
    return t.select("variable", rnd("dim1").alias("dim1"), rnd("dim2").alias("dim2"), rnd("strength").alias("strength"),
                    "rank")


@query("pca_coordinates", ("STAT-06", "TOP-08"))
def pca_coordinates(spark, sf_dir):
    names, res, med = _pca(spark, sf_dir, with_medians=True)
    z = S.impute_standardise(_block(spark, sf_dir), PCA_VARS, ddof=0, keep=["l_orderkey", "l_linenumber", "l_returnflag"],
                             medians=med)
    z = z.withColumn("row_key", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    return S.coordinates(z, res, "row_key", label="l_returnflag", top_labels_n=2)


def _contingency(spark, sf_dir):
    cust = T(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nat = T(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    o = T(spark, sf_dir, "orders").join(cust, "o_custkey").join(nat, "c_nationkey")
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = o.groupBy("n_name").pivot("o_orderpriority", levels).count().fillna(0)
    cols = [f"p{i}" for i in range(len(levels))]
    return wide.toDF("n_name", *cols), cols


@query("contingency_zscore", ("STAT-07", "AGG-17", "AGG-13"), """
WITH c AS (
  SELECT n.n_name, o.o_orderpriority, count(*) AS k
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  GROUP BY 1, 2
), g AS (
  SELECT n.n_name, pr.p FROM (SELECT DISTINCT n_name FROM c) n
  CROSS JOIN (SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS p) pr
), d AS (SELECT g.n_name, g.p, CAST(coalesce(c.k, 0) AS DOUBLE) AS k FROM g LEFT JOIN c ON c.n_name = g.n_name AND c.o_orderpriority = g.p)
SELECT n_name, p AS priority, round((k - avg(k) OVER (PARTITION BY p)) / stddev_samp(k) OVER (PARTITION BY p), 6) AS z FROM d
""")
def contingency_zscore(spark, sf_dir):
    wide, cols = _contingency(spark, sf_dir)
    z = S.standardise_columns(wide, cols, keep=["n_name"])
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    stacked = F.explode(F.array(*[F.struct(F.lit(l).alias("priority"), F.col(c).alias("z")) for l, c in zip(levels, cols)]))
    return z.select("n_name", stacked.alias("s")).select("n_name", "s.priority", rnd("s.z").alias("z"))


@query("bartlett_test", ("STAT-08",))
def bartlett_test(spark, sf_dir):
    wide, cols = _contingency(spark, sf_dir)
    R, n = S.correlation_matrix(wide, cols)
    chi2, p, df = S.bartlett_sphericity(R, n)
    zs = S.standardise_columns(wide, cols)
    Rz, nz = S.correlation_matrix(zs, cols)
    chi2z, pz, _ = S.bartlett_sphericity(Rz, nz)
    return spark.createDataFrame([("raw", chi2, p, df), ("standardised", chi2z, pz, df)],
                                 "table string, chi2 double, p_value double, dof int")


@query("factor_count", ("STAT-09",))
def factor_count(spark, sf_dir):
    wide, cols = _contingency(spark, sf_dir)
    R, _ = S.correlation_matrix(S.standardise_columns(wide, cols), cols)
    k, ev = S.kaiser_count(R)
    return spark.createDataFrame([(i + 1, float(e), bool(e > 1)) for i, e in enumerate(ev)],
                                 "factor int, eigenvalue double, kept boolean")


@query("factor_loadings", ("STAT-10", "STAT-08", "STAT-09"))
def factor_loadings(spark, sf_dir):
    """The whole flow: Bartlett gate, Kaiser count, loadings per rotation."""
    wide, cols = _contingency(spark, sf_dir)
    flow = S.factor_flow(wide, cols, cut=0.5)
    rows = [(rot, cols[i], j + 1, float(L[i, j])) for rot, L in flow.loadings.items()
            for i in range(L.shape[0]) for j in range(L.shape[1])]
    return spark.createDataFrame(rows, "rotation string, variable string, factor int, loading double")


@query("factor_rotation_invariants", ("STAT-10", "STAT-09"), """
SELECT r AS rotation, 'p' || i AS variable, 0.0::DOUBLE AS communality_moved, true AS criterion_holds
FROM (SELECT unnest(['varimax', 'quartimax']) AS r) CROSS JOIN range(5) t(i)
""")
def factor_rotation_invariants(spark, sf_dir):
    """A rotation moves no variable's communality, and does not make its own criterion smaller."""
    wide, cols = _contingency(spark, sf_dir)
    C, _ = S.covariance_matrix(S.standardise_columns(wide, cols), cols, ddof=0)
    k = max(S.kaiser_count(S.correlation_matrix(wide, cols)[0])[0], 2)
    plain = S.factor_analysis(C, k)
    rows = []
    for name, gamma in (("varimax", 1.0), ("quartimax", 0.0)):
        turned = S.factor_analysis(C, k, name)
        moved = np.abs((turned ** 2).sum(1) - (plain ** 2).sum(1))
        holds = S.orthomax_criterion(turned, gamma) >= S.orthomax_criterion(plain, gamma) - 1e-9
        rows += [(name, c, abs(round(float(m), 6)), bool(holds)) for c, m in zip(cols, moved)]
    return spark.createDataFrame(rows, "rotation string, variable string, communality_moved double, criterion_holds boolean")


def _drop_path_sql():
    pairs = "\nUNION ALL ".join(f"SELECT '{a}' AS v, '{b}' AS w, abs(corr({a}, {b})) AS r FROM z" for a in PCA_VARS for b in PCA_VARS if a != b)
    steps = []
    for i in range(3):
        left = " AND ".join(f"{x} NOT IN (SELECT v FROM d{j})" for j in range(i) for x in ("v", "w")) or "true"
        steps.append(f"d{i} AS (SELECT v, avg(r) AS m FROM c WHERE {left} GROUP BY v ORDER BY m, v LIMIT 1)")
    return _IMPUTED_SQL + f", c AS ({pairs}), " + ", ".join(steps) + "\n" + "\nUNION ALL ".join(
        f"SELECT {i + 1} AS step, v AS variable, round(m, 6) AS mean_abs_r FROM d{i}" for i in range(3))


@query("subset_search_path", ("STAT-02", "AGG-20"), _drop_path_sql())
def subset_search_path(spark, sf_dir):
    """The order in which the subset search drops columns, each with its mean |r| at that step."""
    R, _ = _corr(spark, sf_dir)
    rows = [(i + 1, v, m) for i, (v, m) in enumerate(S.drop_path(R, PCA_VARS, min_cols=4))]
    return spark.createDataFrame(rows, "step int, variable string, mean_abs_r double").select("step", "variable", rnd("mean_abs_r").alias("mean_abs_r"))


@query("pca_invariants", ("STAT-04", "STAT-05", "STAT-06", "TOP-08"), """
SELECT 'coordinates' AS of, i AS dim_i, j AS dim_j, 0.0::DOUBLE AS off FROM range(1, 3) a(i), range(1, 3) b(j)
UNION ALL SELECT 'loadings', i, j, 0.0 FROM range(1, 3) a(i), range(1, 3) b(j)
UNION ALL SELECT 'strength', 1, 2, 0.0
""")
def pca_invariants(spark, sf_dir):
    """What holds for any principal components, as differences that must be 0: the coordinates' second moments are
    the eigenvalues on the diagonal and 0 beside it, the loadings are orthonormal, and the variables named as
    the strongest hold the greatest squared loadings."""
    names, res, med = _pca(spark, sf_dir, with_medians=True)
    z = S.impute_standardise(_block(spark, sf_dir), PCA_VARS, ddof=0, keep=["l_orderkey"], medians=med)
    dims = S.coordinates(z, res, "l_orderkey")
    pairs = [(i, j) for i in (1, 2) for j in (1, 2)]
    moments = dims.agg(*[F.avg(F.col(f"Dim{i}") * F.col(f"Dim{j}")).alias(f"m{i}{j}") for i, j in pairs]).first()
    unit = res.loadings / np.linalg.norm(res.loadings, axis=0)
    scale = np.linalg.norm(res.loadings, axis=0)                       # loadings may carry the eigenvalues' roots
    rows = [("coordinates", i, j, moments[f"m{i}{j}"] - (res.ratios[i - 1] * len(names) * scale[i - 1] ** 2 if i == j else 0.0)) for i, j in pairs]
    rows += [("loadings", i, j, float(unit[:, i - 1] @ unit[:, j - 1]) - (i == j)) for i, j in pairs]
    top = S.top_loadings(spark, res, k=2).agg(F.sum("strength")).first()[0]
    rows.append(("strength", 1, 2, top - float(np.sort(np.hypot(res.loadings[:, 0], res.loadings[:, 1]))[-2:].sum())))
    return spark.createDataFrame([(o, i, j, abs(round(float(v), 6))) for o, i, j, v in rows], "of string, dim_i long, dim_j long, off double")
