"""Quantiles, statistics and binning against numpy / pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadenza.operators import stats as S
from cadenza.operators.charts import equal_width_edges
from cadenza.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("q", [0.5, 0.25, 0.9])
def test_exact_quantiles_match_numpy(spark, q):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(size=30000), np.full(20000, 3.0)])      # a hot value: 40 % of rows
    b = rng.integers(0, 5, size=50000).astype(float)
    pdf = pd.DataFrame({"a": a, "b": b})
    pdf.loc[::17, "b"] = np.nan
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["a", "b"], q, bins=64)
    assert got["a"] == pytest.approx(np.quantile(a, q), abs=1e-12)
    assert got["b"] == pytest.approx(np.nanquantile(pdf["b"], q), abs=1e-12)


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame(pd.DataFrame(X, columns=list("abcd")))
    R, n = S.correlation_matrix(df, list("abcd"))
    assert np.allclose(R, np.corrcoef(X, rowvar=False))
    res = S.pca_from_corr(R, n, list("abcd"))
    Z = (X - X.mean(0)) / X.std(0)
    ev = np.sort(np.linalg.eigvalsh(np.cov(Z, rowvar=False)))[::-1]
    assert np.allclose(res.eigenvalues, ev)
    assert abs(res.ratios.sum() - 1) < 1e-9


def test_bartlett_closed_form():
    R = np.array([[1.0, 0.5], [0.5, 1.0]])
    chi2, p, df = S.bartlett_sphericity(R, 50)
    assert df == 1
    assert chi2 == pytest.approx(-(49 - 9 / 6) * math.log(0.75))
    # chi2 with 1 dof: survival = erfc(sqrt(x/2))
    assert p == pytest.approx(math.erfc(math.sqrt(chi2 / 2)), rel=1e-9)


def test_gamma_survival_large_x():
    # chi2(4) survival at 10 = exp(-5)(1 + 5)
    assert S._gammaincc(2.0, 5.0) == pytest.approx(math.exp(-5) * 6, rel=1e-10)


def test_factor_analysis_shapes():
    rng = np.random.default_rng(3)
    F_ = rng.normal(size=(500, 2))
    X = F_ @ rng.normal(size=(2, 5)) + 0.3 * rng.normal(size=(500, 5))
    C = np.cov((X - X.mean(0)) / X.std(0), rowvar=False, ddof=0)
    for rot in (None, "varimax", "quartimax"):
        L = S.factor_analysis(C, 2, rot)
        assert L.shape == (5, 2)
        assert np.all(np.sum(L ** 2, axis=1) <= 1.0 + 1e-6)


def test_kaiser():
    R = np.array([[1, .8, 0], [.8, 1, 0], [0, 0, 1.0]])
    k, ev = S.kaiser_count(R)
    assert k == 1 and ev[0] == pytest.approx(1.8)


def test_cut_edges_match_pandas():
    x = np.array([80.0, 95.5, 100.0, 120.25, 161.0, 180.0])
    edges, mids = equal_width_edges(x.min(), x.max(), 12)
    cats = pd.cut(x, 12)
    pd_mids = [iv.mid for iv in cats.categories]
    assert np.allclose(mids, pd_mids)
    ours = np.searchsorted(np.array(edges[1:-1]), x, side="left") + 1
    assert list(ours) == list(cats.codes + 1)


def test_subset_search_stops_at_target():
    R = np.eye(5)
    R[0, 1] = R[1, 0] = 0.9
    names = list("abcde")
    keep, res = S.subset_search(R, 100, names, min_cols=4, target=0.5)
    assert len(keep) >= 4


def test_grouped_median_matches_pandas(spark):
    from cadenza.operators.aggregates import grouped_median
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 3000), "v": rng.integers(0, 40, 3000).astype(float)})
    pdf.loc[pdf.g == 0, "v"] = 7.0                      # a group with a single value
    pdf = pd.concat([pdf, pd.DataFrame({"g": [9, 9], "v": [1.0, 2.0]})])
    got = {r["g"]: r["m"] for r in grouped_median(spark.createDataFrame(pdf), ["g"], "v", "m").collect()}
    want = pdf.groupby("g")["v"].median().to_dict()
    assert got == pytest.approx(want)


def test_apply_prep_fills_absent_columns(spark):
    from cadenza.operators import regress as G
    train = spark.createDataFrame([(1.0, 10.0, 5.0), (3.0, 30.0, 7.0), (5.0, None, 9.0)], "a double, b double, y double")
    meta = G.fit_prep(train, ["a", "b"], "y")
    assert meta.medians == {"a": 3.0, "b": 20.0}
    new = spark.createDataFrame([(3.0,), (float("inf"),)], "a double")        # column b absent, a infinite
    out = G.apply_prep(new, meta).collect()
    b_z = (20.0 - meta.means["b"]) / meta.stds["b"]
    assert out[0]["a"] == pytest.approx(0.0) and out[0]["b"] == pytest.approx(b_z)
    assert out[1]["a"] == pytest.approx(0.0)                                  # inf -> median -> 0


def test_factor_flow_gate(spark):
    rows = [(1.0, 1.0, 1.0), (-1.0, 1.0, -1.0), (1.0, -1.0, -1.0), (-1.0, -1.0, 1.0)] * 5
    df = spark.createDataFrame(rows, "a double, b double, c double")      # orthogonal columns: R = I
    flow = S.factor_flow(df, ["a", "b", "c"], cut=0.5)
    assert not flow.relevant and flow.bartlett["raw"][1] == pytest.approx(1.0)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 1))
    X = np.hstack([base + 0.1 * rng.normal(size=(200, 1)) for _ in range(4)])
    flow = S.factor_flow(spark.createDataFrame(pd.DataFrame(X, columns=list("wxyz"))), list("wxyz"))
    assert flow.relevant and flow.n_factors == 1 and set(flow.loadings) == {"none", "varimax", "quartimax"}
