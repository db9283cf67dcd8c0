"""OLS operator: numpy re-solve, known identities, covariance flags."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cordon.operators import regression as R


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(7)
    rows = []
    start = dt.date(2024, 1, 1)
    for day in range(120):
        d = start + dt.timedelta(days=day)
        for g in (0, 1):
            y = 5 + 0.5 * g + 0.01 * day + 0.004 * g * day + rng.normal(0, 0.3)
            y -= 1.2 * g * (d >= dt.date(2024, 3, 15))
            rows.append((d, g, int(d >= dt.date(2024, 3, 15)), float(y),
                         d.strftime("%Y-%m"), d.weekday(), day % 9))
    return spark.createDataFrame(
        rows, "date date, treated int, post int, y double, month string, dow int, zone int")


def _np_ols(pdf, cols):
    x = np.column_stack([np.ones(len(pdf))] + [pdf[c].to_numpy(float) for c in cols])
    y = pdf["y"].to_numpy(float)
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    e = y - x @ b
    xtx_inv = np.linalg.inv(x.T @ x)
    n, k = x.shape
    hc1 = xtx_inv @ (x.T * e ** 2) @ x @ xtx_inv * n / (n - k)
    return b, np.sqrt(np.diag(hc1)), x, e, xtx_inv


def test_matches_numpy_hc1(panel):
    pdf = panel.toPandas()
    pdf["tp"] = pdf.treated * pdf.post
    b, se, *_ = _np_ols(pdf, ["treated", "post", "tp"])
    out = R.ols(panel, "y", {"treated": F.col("treated"), "post": F.col("post"),
                             "treated:post": F.col("treated") * F.col("post")}).toPandas()
    assert np.allclose(out.coef.to_numpy(), b, rtol=1e-9, atol=1e-9)
    assert np.allclose(out.se.to_numpy(), se, rtol=1e-7)
    assert out.n.iloc[0] == len(pdf) and out.k.iloc[0] == 4


def test_cluster_matches_numpy_and_flags_two_clusters(panel):
    pdf = panel.toPandas()
    pdf["tp"] = pdf.treated * pdf.post
    b, _, x, e, inv = _np_ols(pdf, ["treated", "post", "tp"])
    n, k = x.shape
    s = pd.DataFrame(x * e[:, None]).groupby(pdf.zone.to_numpy()).sum().to_numpy()
    g = s.shape[0]
    cov = inv @ (s.T @ s) @ inv * g / (g - 1) * (n - 1) / (n - k)
    terms = {"treated": F.col("treated"), "post": F.col("post"),
             "treated:post": F.col("treated") * F.col("post")}
    out = R.ols(panel, "y", terms, cov_type="cluster", cluster_col="zone").toPandas()
    assert np.allclose(out.se.to_numpy(), np.sqrt(np.diag(cov)), rtol=1e-7)
    assert out.clusters.iloc[0] == 9 and out.warning.isna().all()
    two = R.ols(panel, "y", terms, cov_type="cluster", cluster_col="treated").toPandas()
    assert two.warning.iloc[0].startswith("degenerate")


def test_pretrend_equals_slope_difference(panel, spark):
    cutoff = dt.date(2024, 3, 15)
    res = R.pretrend_test(panel, cutoff, y="y").first()
    pre = panel.filter(F.col("date") < F.lit(cutoff)).withColumn(
        "t", F.datediff("date", F.lit(dt.date(2024, 1, 1))).cast("double"))
    sl = {r.treated: r.s for r in pre.groupBy("treated").agg(F.regr_slope("y", "t").alias("s")).collect()}
    assert res.coef == pytest.approx(sl[1] - sl[0], rel=1e-9, abs=1e-12)
    assert res.verdict in ("significant pre-trend", "no significant pre-trend")


def test_fe_did_equals_2x2_on_balanced_panel(panel):
    """With month and weekday fixed effects on a balanced two-group panel,
    the interaction equals the 2x2 difference of daily means."""
    res = R.did_regression(panel, y="y").first()
    m = {(r.treated, r.post): r.m for r in
         panel.groupBy("treated", "post").agg(F.avg("y").alias("m")).collect()}
    did = (m[(1, 1)] - m[(1, 0)]) - (m[(0, 1)] - m[(0, 0)])
    assert res.coef == pytest.approx(did, rel=1e-9)
    assert res.k == 1 + 3 + 3 + 6          # 4 months, 7 weekdays


def test_nonrobust_matches_numpy(panel):
    pdf = panel.toPandas()
    pdf["tp"] = pdf.treated * pdf.post
    b, _, x, e, inv = _np_ols(pdf, ["treated", "post", "tp"])
    n, k = x.shape
    se = np.sqrt(np.diag(inv * (e @ e) / (n - k)))
    out = R.ols(panel, "y", {"treated": F.col("treated"), "post": F.col("post"),
                             "treated:post": F.col("treated") * F.col("post")},
                cov_type="nonrobust").toPandas()
    assert np.allclose(out.se.to_numpy(), se, rtol=1e-7)


def test_absorbing_equals_dummies(panel):
    """Demeaning by a factor gives the coefficients and HC1 errors of its
    dummies."""
    terms = {"treated": F.col("treated"), "post": F.col("post"),
             "treated:post": F.col("treated") * F.col("post")}
    a = R.ols(panel, "y", terms, categoricals=("dow",), absorb="month").toPandas().set_index("term")
    d = R.ols(panel, "y", terms, categoricals=("dow", "month")).toPandas().set_index("term")
    assert np.allclose(a.coef, d.coef[a.index], rtol=1e-7, atol=1e-9)
    assert np.allclose(a.se, d.se[a.index], rtol=1e-6)
    assert (a.k == d.k.iloc[0]).all()


def test_rows_with_nulls_are_dropped(spark):
    rows = [(1.0 + 2 * x, None if x % 4 == 0 else float(x)) for x in range(40)]
    out = R.ols(spark.createDataFrame(rows, "y double, x double"), "y", {"x": F.col("x")}).toPandas()
    assert out.coef.iloc[1] == pytest.approx(2.0) and out.n.iloc[0] == 30


def test_boolean_and_null_factors(spark):
    rows = [(float(i % 5) + (3.0 if i % 2 else 0.0), bool(i % 2) if i != 7 else None, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "y double, b boolean, g int")
    out = R.ols(df, "y", {}, categoricals=("b",), cov_type="cluster", cluster_col="g").toPandas()
    ys = [(y, b) for y, b, _ in rows if b is not None]
    want = np.mean([y for y, b in ys if b]) - np.mean([y for y, b in ys if not b])
    assert list(out.term) == ["Intercept", "C(b)[T.true]"]
    assert out.coef.iloc[1] == pytest.approx(want) and out.n.iloc[0] == 59 and out.clusters.iloc[0] == 3


def test_zone_day_panel_is_zero_filled(spark):
    from conftest import SF001
    from cordon.config import TPCH_TRIPS
    from cordon.operators import panel as P
    from cordon.plans.warehouse import tpch_warehouse
    wh = tpch_warehouse(spark, SF001)
    got = P.zone_day_panel(wh.zone_day, wh.dim_zone, TPCH_TRIPS)
    days = (TPCH_TRIPS.window_end - TPCH_TRIPS.window_start).days
    zones = got.select("zone").distinct().count()
    assert got.count() == zones * days and got.filter("trips = 0").count() > 0
    assert got.agg(F.sum("trips")).first()[0] == wh.fact.filter("pu_is_cbd is not null").count()


def _cells(spark, keep):
    rng = np.random.default_rng(3)
    rows = [(g, p, float(5 + g + p + rng.normal())) for _ in range(9) for g in (0, 1) for p in (0, 1) if keep(g, p)]
    return spark.createDataFrame(rows, "treated int, post int, y double")


@pytest.mark.parametrize("keep,lost", [(lambda g, p: g == 0, {"treated", "treated:post"}),
                                       (lambda g, p: p == 0, {"post", "treated:post"}),
                                       (lambda g, p: not (g and p), {"treated:post"})])
def test_effects_that_are_not_identified_are_null(spark, keep, lost):
    """No treated unit, no post period, an empty corner: NULL and a warning, and
    the terms that stay identified keep their estimates."""
    df = _cells(spark, keep)
    terms = {"treated": F.col("treated"), "post": F.col("post"), "treated:post": F.col("treated") * F.col("post")}
    out = R.ols(df, "y", terms, cov_type=("HC1", "nonrobust")).collect()
    for r in out:
        gone = r.term in lost
        assert (r.coef is None) == gone and (r.ci_lo is None) == gone, r
        assert ("not identified" in (r.warning or "")) == gone and "rank deficient" in r.warning


def test_collinear_terms_are_null(spark):
    rows = [(float(i % 7), float(i % 3), 2.0 * (i % 3)) for i in range(40)]
    out = {r.term: r for r in R.ols(spark.createDataFrame(rows, "y double, a double, b double"), "y",
                                    {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert out["a"].coef is None and out["b"].coef is None and out["Intercept"].coef is not None
    pdf = pd.DataFrame(rows, columns=["y", "a", "b"])
    x = np.column_stack([np.ones(40), pdf.a])
    assert out["Intercept"].coef == pytest.approx(np.linalg.lstsq(x, pdf.y, rcond=None)[0][0])


def test_pretrend_without_rows_is_not_assessable(panel):
    res = R.pretrend_test(panel, dt.date(2020, 1, 1), y="y").first()
    assert res.verdict == "not assessable" and res.coef is None and res.n == 0
    res = R.pretrend_test(panel.filter("treated = 0"), dt.date(2024, 3, 15), y="y").first()
    assert res.verdict == "not assessable" and res.coef is None


def test_saturated_design_has_no_error(spark):
    out = R.ols(spark.createDataFrame([(1.0, 0.0), (3.0, 1.0)], "y double, x double"), "y", {"x": F.col("x")}).collect()
    assert [r.coef for r in out] == pytest.approx([1.0, 2.0]) and all(r.se is None for r in out)
    assert "no residual degrees of freedom" in out[0].warning


def test_two_absorbed_factors_equal_dummies(spark):
    """An unbalanced panel in two components: alternating projections give the
    dummies' coefficient, errors and rank."""
    rng = np.random.default_rng(5)
    rows = []
    for u in range(8):
        for t in range(10):
            if rng.random() < 0.6 and (u < 5) == (t < 6):
                d = int(u % 2 and t % 5 > 2)
                rows.append((f"u{u}", f"t{t}", d, float(u + 0.3 * t + 2 * d + rng.normal())))
    df = spark.createDataFrame(rows, "u string, t string, d int, y double")
    out = R.ols(df, "y", {"d": F.col("d")}, absorb=("u", "t"), cov_type=("HC1", "cluster"), cluster_col="u").toPandas()
    pdf = df.toPandas()
    x = np.column_stack([pdf.d, *[pdf[c] == v for c in "ut" for v in sorted(pdf[c].unique())]]).astype(float)
    rank = np.linalg.matrix_rank(x)
    inv = np.linalg.pinv(x.T @ x)
    e = pdf.y - x @ (inv @ x.T @ pdf.y)
    n = len(pdf)
    hc1 = inv @ (x.T * e.to_numpy() ** 2) @ x @ inv * n / (n - rank)
    s = pd.DataFrame(x * e.to_numpy()[:, None]).groupby(pdf.u.to_numpy()).sum().to_numpy()
    cl = inv @ (s.T @ s) @ inv * len(s) / (len(s) - 1) * (n - 1) / (n - rank)
    assert out.coef.to_numpy() == pytest.approx((inv @ x.T @ pdf.y)[0], rel=1e-7)
    assert out.se.to_numpy() == pytest.approx([hc1[0, 0] ** 0.5, cl[0, 0] ** 0.5], rel=1e-6)
    assert (out.k == rank).all() and out.warning.isna().all()
    assert R.connected(df, "u", "t") == 2


def test_large_factors_are_absorbed_not_collected(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("f"), F.rand(1).alias("y"))
    with pytest.raises(ValueError, match="absorb it"):
        R.ols(df, "y", {}, categoricals=("f",))


def test_mllib_gives_the_same_estimates(panel):
    """An independent solver: normal equations of MLlib over an R formula."""
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import LinearRegression
    df = panel.withColumn("dow", F.col("dow").cast("string"))
    ready = RFormula(formula="y ~ treated + post + treated:post + month + dow").fit(df).transform(df)
    fit = LinearRegression(solver="normal", regParam=0.0).fit(ready)
    names = [a["name"] for kind in ready.schema["features"].metadata["ml_attr"]["attrs"].values()
             for a in sorted(kind, key=lambda a: a["idx"])]
    order = sorted((a["idx"], a["name"]) for kind in ready.schema["features"].metadata["ml_attr"]["attrs"].values() for a in kind)
    at = [n for _, n in order].index("treated:post")
    terms = {"treated": F.col("treated"), "post": F.col("post"), "treated:post": F.col("treated") * F.col("post")}
    own = R.ols(panel, "y", terms, categoricals=("month", "dow"), cov_type="nonrobust").toPandas().set_index("term")
    assert len(names) == len(order) == len(own) - 1
    assert own.coef["treated:post"] == pytest.approx(fit.coefficients[at], rel=1e-8)
    assert own.se["treated:post"] == pytest.approx(fit.summary.coefficientStandardErrors[at], rel=1e-8)


def _units(spark, treated, seed=2, n=9):
    rng = np.random.default_rng(seed)
    rows = [(f"z{u}", int(u in treated), int(t >= 4), float(rng.integers(0, 40) + 30 * (u in treated and t >= 4)))
            for u in range(n) for t in range(7)]
    return spark.createDataFrame(rows, "zone string, treated int, post int, trips double"), rows


@pytest.mark.parametrize("draws", [20_000, 50])
def test_permutation_test_against_enumeration(spark, draws):
    import itertools

    from cordon.operators import permutation as P
    df, rows = _units(spark, {1, 4, 6})
    pdf = pd.DataFrame(rows, columns=["zone", "treated", "post", "trips"])
    change = pdf[pdf.post == 1].groupby("zone").trips.mean() - pdf[pdf.post == 0].groupby("zone").trips.mean()

    def did(own):
        return change[list(own)].mean() - change.drop(list(own)).mean()

    real = did(["z1", "z4", "z6"])
    got = P.did_permutation(df, draws=draws).first()
    assert got.did_estimate == pytest.approx(real) and got.units == 9 and got.treated_units == 3
    if draws > 84:
        sets = [did(c) for c in itertools.combinations(change.index, 3)]
        hits = sum(abs(x) >= abs(real) - 1e-9 for x in sets)
        assert (got.method, got.sets, got.at_least_as_large) == ("exact", 84, hits) and got.p_value == hits / 84
    else:
        import hashlib
        hits = 0
        for d in range(1, draws + 1):
            own = sorted(change.index, key=lambda z: hashlib.md5(f"{P.SEED}|{d}|{z}".encode()).hexdigest())[:3]
            hits += abs(did(own)) >= abs(real) - 1e-9
        assert (got.method, got.sets, got.at_least_as_large) == ("drawn", draws + 1, hits + 1)


@pytest.mark.parametrize("treated", [set(), set(range(9))])
def test_permutation_without_a_contrast(spark, treated):
    from cordon.operators import permutation as P
    got = P.did_permutation(_units(spark, treated)[0]).first()
    assert got.p_value is None and got.warning.startswith("not identified")
    one_period = _units(spark, {1})[0].filter("post = 0")
    assert P.did_permutation(one_period).first().warning == "not identified: a period has no days"
