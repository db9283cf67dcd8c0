"""Ordinary least squares as distributed aggregations.

One engine for every design: the cross products of ``[X y]`` - ``X'X``,
``X'y``, ``y'y`` - are built-in aggregates over the rows (JVM only, combined
map-side), and only that K x K system reaches the driver, where it is solved
with a pseudo-inverse.  The covariance passes are aggregates too: ``sum e^2 x
x'`` (HC1), or per-cluster score sums ``s_g = sum x e`` by ``groupBy(cluster)``
followed by ``sum s_g s_g'``.

Large factors are *absorbed*: the outcome and every other column lose their
group means, factor after factor until nothing is left of them (one pass for
one factor, alternating projections for several), so their levels never enter K
nor the driver.  The rank of two absorbed factors is the number of their levels
less the connected components of the levels that occur together.  Further
factors become dummies, at most MAX_LEVELS levels each (weekdays).  Rows with a
NULL in any used column are dropped, factors and clusters are compared as text.

A term is estimable only if its unit vector lies in the row space of ``X'X``
(a group without rows, a period without days or a collinear column break that).
Of a term that is not, the coefficient, its error, z, p and interval are NULL
and ``warning`` says so; other terms keep their estimates.

Covariance choices: ``nonrobust``, ``HC1`` and ``cluster``.  With two or
fewer clusters the cluster-robust covariance is degenerate (the normal
equations force the score sums of any group-level regressor to zero), which
the output flags in ``warning`` instead of presenting a meaningless p-value
as sound.  Inference uses the normal distribution, as is usual for robust
covariance.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordon.plans.scratch import scratch_path

Z975 = 1.959963984540054  # two-sided 95 % normal critical value
#: Aggregate expressions of one job; wider designs take several jobs.
PRODUCTS_PER_JOB = 300
#: Most levels of a factor that becomes dummies; larger ones are absorbed.
MAX_LEVELS = 100
#: What is left of a column, as a share of its sum of squares, counts as nothing below this.
NOTHING = 1e-12
#: Alternating projections end when no group mean is larger than this share of its column's root mean square.
CONVERGED = 1e-10
MAX_SWEEPS = 1000

RESULT_SCHEMA = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("coef", T.DoubleType()),
    T.StructField("se", T.DoubleType()),
    T.StructField("z", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("ci_lo", T.DoubleType()),
    T.StructField("ci_hi", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("clusters", T.LongType()),
    T.StructField("cov_type", T.StringType()),
    T.StructField("warning", T.StringType()),
])


def gram(df: DataFrame, cols: list[Column], weight: Column | None = None) -> np.ndarray:
    """Symmetric matrix ``sum_rows w * v v'`` of the columns."""
    k = len(cols)
    at = [(i, j) for i in range(k) for j in range(i, k)]
    m = np.zeros((k, k))
    for lo in range(0, len(at), PRODUCTS_PER_JOB):
        part = at[lo:lo + PRODUCTS_PER_JOB]
        products = [cols[i] * cols[j] if weight is None else cols[i] * cols[j] * weight for i, j in part]
        for (i, j), v in zip(part, df.agg(*[F.sum(p) for p in products]).first(), strict=True):
            m[i, j] = m[j, i] = float(v or 0.0)
    return m


def factor_levels(df: DataFrame, factors: list[str]) -> dict[str, list[str]]:
    """Sorted distinct levels of every factor."""
    out: dict[str, list[str]] = {c: [] for c in factors}
    if factors:
        n = df.agg(*[F.count_distinct(c).alias(c) for c in factors]).first()
        for c in factors:
            if n[c] > MAX_LEVELS:
                raise ValueError(f"{c} has {n[c]} levels, more than {MAX_LEVELS}: absorb it")
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in factors]))
        for r in df.select(pairs.alias("e")).select("e.*").distinct().collect():
            out[r.c].append(r.v)
    return {c: sorted(v) for c, v in out.items()}


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _squares(df: DataFrame, cols: list[str]) -> list[float]:
    return [float(v or 0.0) for v in df.agg(*[F.sum(F.col(c) * F.col(c)) for c in cols]).first()]


def absorbed(df: DataFrame, cols: list[str], factors: list[str]) -> DataFrame:
    """``df`` with ``cols`` freed of the means of every factor's groups."""
    scale = [math.sqrt(v / max(df.count(), 1)) or 1.0 for v in _squares(df, cols)]
    for _ in range(MAX_SWEEPS):
        left = 0.0
        for f in factors:
            means = _stored(df.groupBy(f).agg(*[F.avg(c).alias(f"_m{c}") for c in cols]), "ols_means")
            top = means.agg(*[F.max(F.abs(F.col(f"_m{c}"))) for c in cols]).first()
            left = max([left, *[float(v or 0.0) / s for v, s in zip(top, scale, strict=True)]])
            keep = [c for c in df.columns if c not in cols]
            df = df.join(means, f).select(*keep, *[(F.col(c) - F.col(f"_m{c}")).alias(c) for c in cols])
        df = _stored(df, "ols_within")
        if len(factors) == 1 or left < CONVERGED:
            return df
    raise RuntimeError(f"absorbing {factors} has not converged in {MAX_SWEEPS} sweeps")


def connected(pairs: DataFrame, a: str, b: str) -> int:
    """Connected components of the levels of ``a`` and ``b`` that occur together."""
    edge = _stored(pairs.select(a, b).distinct(), "ols_edges")
    label = _stored(edge.groupBy(a).agg(F.min(a).alias("l")), "ols_labels")
    while True:
        other = edge.join(label, a).groupBy(b).agg(F.min("l").alias("l"))
        new = _stored(edge.join(other, b).groupBy(a).agg(F.min("l").alias("l")), "ols_labels")
        if new.join(label.withColumnRenamed("l", "was"), a).filter("l <> was").isEmpty():
            return new.select("l").distinct().count()
        label = new


def absorbed_rank(df: DataFrame, factors: list[str]) -> int:
    """Parameters that absorbed factors take (of a third and further factor,
    one level each is counted as redundant)."""
    if not factors or df.isEmpty():
        return 0
    levels = list(df.agg(*[F.count_distinct(f) for f in factors]).first())
    if len(factors) == 1:
        return levels[0]
    return sum(levels) - connected(df, *factors[:2]) - (len(factors) - 2)


def _design(df: DataFrame, y: str, terms: dict[str, Column], factors: list[str], absorb: list[str],
            cluster_col: str | None) -> tuple[DataFrame, list[str], int, list[float]]:
    """(rows with x0.., y and g written once, names of the x, absorbed
    parameters, sums of squares of the x before absorbing)."""
    used = df.select(*[c.cast("double").alias(f"_t{i}") for i, c in enumerate(terms.values())],
                     *[F.col(c).cast("string").alias(c) for c in dict.fromkeys([*factors, *absorb])],
                     F.col(y).cast("double").alias("_y"),
                     *([F.col(cluster_col).cast("string").alias("_g")] if cluster_col else [])).na.drop()
    src = _stored(used, "ols_rows")
    names, cols = list(terms), [F.col(f"_t{i}") for i in range(len(terms))]
    for c, levels in factor_levels(src, factors).items():
        names += [f"C({c})[T.{v}]" for v in levels[1:]]
        cols += [F.when(F.col(c) == v, 1.0).otherwise(0.0) for v in levels[1:]]
    keep = ["_g"] if cluster_col else []
    if not absorb:
        names, cols = ["Intercept", *names], [F.lit(1.0), *cols]
    own = [f"_x{i}" for i in range(len(cols))]
    wide = src.select(*[c.alias(n) for c, n in zip(cols, own, strict=True)], "_y",
                      *[F.col(f).alias(f"_f{i}") for i, f in enumerate(absorb)], *keep)
    before = _squares(wide, own)
    if not absorb:
        return wide, names, 0, before
    by = [f"_f{i}" for i in range(len(absorb))]
    return absorbed(wide, [*own, "_y"], by), names, absorbed_rank(wide, by), before


def solve(g: np.ndarray, before: list[float]) -> tuple[np.ndarray, int, np.ndarray]:
    """(pseudo-inverse, rank, estimable) of the cross products ``g`` of columns
    whose sums of squares were ``before`` at first."""
    p = len(g)
    there = np.array([g[i, i] > NOTHING * max(b, 1e-300) for i, b in enumerate(before)], bool)
    inverse, estimable = np.zeros((p, p)), np.zeros(p, bool)
    if not there.any():
        return inverse, 0, estimable
    scale = 1.0 / np.sqrt(np.diag(g)[there])
    values, vectors = np.linalg.eigh(g[np.ix_(there, there)] * np.outer(scale, scale))
    solid = values > 1e-10 * values.max()
    part = (vectors[:, solid] / values[solid]) @ vectors[:, solid].T * np.outer(scale, scale)
    inverse[np.ix_(there, there)] = part
    estimable[there] = (np.abs(vectors[:, ~solid]) < 1e-6).all(1)
    return inverse, int(solid.sum()), estimable


def ols(df: DataFrame, y: str, terms: dict[str, Column], categoricals=(), absorb: str | tuple[str, ...] | None = None,
        cov_type="HC1", cluster_col: str | None = None) -> DataFrame:
    """Coefficients with one or several covariance types (``cov_type`` may be
    a tuple).  ``absorb`` names the factors to demean by; ``k`` counts their
    parameters among the others."""
    cov_types = (cov_type,) if isinstance(cov_type, str) else tuple(cov_type)
    factors = [absorb] if isinstance(absorb, str) else list(absorb or ())
    src, names, taken, before = _design(df, y, terms, list(categoricals), factors, cluster_col)
    p = len(names)
    xs = [F.col(f"_x{i}") for i in range(p)]
    g = gram(src, [*xs, F.col("_y")])
    n = src.count()
    bread, own_rank, estimable = solve(g[:p, :p], before)
    beta = bread @ g[:p, p]
    rank, k = own_rank + taken, p + taken
    residual = F.col("_y")
    for b, x in zip(beta, xs, strict=True):
        residual = residual - F.lit(float(b)) * x
    rows = []
    for ct in cov_types:
        cov, clusters, warning = _covariance(src, xs, residual, bread, n, rank, ct, cluster_col)
        notes = [warning] if warning else []
        if rank < k:
            notes.append(f"rank deficient ({rank} < {k})")
        for i, name in enumerate(names):
            if not estimable[i]:
                rows.append((name, None, None, None, None, None, None, n, k, clusters, ct,
                             "; ".join([*notes, "not identified"])))
                continue
            if n <= rank:
                rows.append((name, float(beta[i]), None, None, None, None, None, n, k, clusters, ct,
                             "; ".join([*notes, "no residual degrees of freedom"])))
                continue
            se = math.sqrt(max(float(cov[i, i]), 0.0))
            z = float(beta[i]) / se if se > 0 else None
            pv = math.erfc(abs(z) / math.sqrt(2.0)) if z is not None else None
            rows.append((name, float(beta[i]), se, z, pv, float(beta[i]) - Z975 * se,
                         float(beta[i]) + Z975 * se, n, k, clusters, ct, "; ".join(notes) or None))
    return df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def _covariance(src: DataFrame, xs: list[Column], e: Column, bread: np.ndarray, n: int, rank: int,
                cov_type: str, cluster_col: str | None):
    free = max(n - rank, 1)
    if cov_type == "nonrobust":
        return bread * (float(src.agg(F.sum(e * e)).first()[0] or 0.0) / free), None, None
    if cov_type == "HC1":
        return bread @ gram(src, xs, e * e) @ bread * (n / free), None, None
    if cov_type != "cluster":
        raise ValueError(f"unknown cov_type {cov_type!r}")
    if not cluster_col:
        raise ValueError("cluster covariance needs cluster_col")
    scores = _stored(src.withColumn("_e", e).groupBy("_g").agg(
        *[F.sum(x * F.col("_e")).alias(f"_s{i}") for i, x in enumerate(xs)]), "ols_scores")
    clusters = scores.count()
    meat = gram(scores, [F.col(f"_s{i}") for i in range(len(xs))])
    factor = (clusters / max(clusters - 1, 1)) * ((n - 1) / free)
    warning = None
    if clusters <= 2:
        warning = f"degenerate: {clusters} clusters; cluster-robust SE is not meaningful"
    return bread @ meat @ bread * factor, clusters, warning


def pretrend_test(panel: DataFrame, cutoff, y: str = "trips_per_zone",
                  cov_type="HC1", cluster_col: str | None = None,
                  alpha: float = 0.05) -> DataFrame:
    """Pre-period only: ``y ~ treated + t + treated:t``, t = days since the
    first pre-period date.  Returns the ``treated:t`` row and a verdict, which
    is "not assessable" where the slopes are not identified."""
    pre = panel.filter(F.col("date") < F.lit(cutoff))
    first = pre.agg(F.min("date")).first()[0]
    pre = pre.withColumn("t", F.datediff(F.col("date"), F.lit(first).cast("date")).cast("double"))
    terms = {"treated": F.col("treated"), "t": F.col("t"),
             "treated:t": F.col("treated") * F.col("t")}
    out = ols(pre, y, terms, cov_type=cov_type, cluster_col=cluster_col)
    return (out.filter(F.col("term") == "treated:t")
            .withColumn("verdict", F.when(F.col("p_value").isNull() | F.col("warning").isNotNull(), "not assessable")
                        .when(F.col("p_value") < alpha, "significant pre-trend")
                        .otherwise("no significant pre-trend")))


def did_regression(panel: DataFrame, y: str = "trips_per_zone", with_fe: bool = True,
                   cov_type="HC1", cluster_col: str | None = None) -> DataFrame:
    """``y ~ treated + post + treated:post [+ C(month) + C(dow)]`` (months
    absorbed); the ``treated:post`` row is the DiD estimate."""
    terms = {"treated": F.col("treated"), "post": F.col("post"),
             "treated:post": F.col("treated") * F.col("post")}
    out = ols(panel, y, terms, categoricals=("dow",) if with_fe else (), absorb="month" if with_fe else None,
              cov_type=cov_type, cluster_col=cluster_col)
    return out.filter(F.col("term") == "treated:post")


def did_two_way(panel: DataFrame, unit: str = "zone", time: str = "date", y: str = "trips",
                cov_type="cluster") -> DataFrame:
    """``y ~ treated:post`` with an effect for every unit and every date (both
    absorbed), errors clustered by unit."""
    out = ols(panel, y, {"treated:post": F.col("treated") * F.col("post")}, absorb=(unit, time),
              cov_type=cov_type, cluster_col=unit)
    return out
