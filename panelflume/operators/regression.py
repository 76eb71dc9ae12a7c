"""Grouped least squares and two-stage least squares from one-pass moments.

Each group is reduced to its row count, means and covariances by `covar_pop`, which merges centred partial states, so
the aggregate combines on the map side and does not lose digits to a large mean. Python sees one row per group and
solves a k x k system there. Constant or collinear regressors get a zero coefficient (pseudo-inverse of the scaled
covariance); they still count in the degrees of freedom.
"""
from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelflume.functions.shapes import record
from panelflume.functions.tails import t_tail

RCOND = 1e-10


def moments(df: DataFrame, variables: list[str], keys: list[str]) -> DataFrame:
    """(keys, n_rows, n, means, covs): covs is the upper triangle, row by row.

    n_rows counts all rows of the group; the n rows without a NULL variable enter the statistics.
    """
    pairs = [(a, b) for i, a in enumerate(variables) for b in variables[i:]]
    whole = reduce(and_, [F.col(v).isNotNull() for v in variables])
    masked = df.select(*keys, *[F.when(whole, F.col(v).cast("double")).alias(v) for v in variables])
    return masked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(variables[0]).alias("n"),
        F.array(*[F.avg(v) for v in variables]).alias("means"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("covs"),
    )


def moment_rows(df: DataFrame, variables: list[str], keys: list[str]) -> DataFrame:
    """The moments as long rows (keys, var_a, var_b, n, covariance)."""
    names = [(a, b) for i, a in enumerate(variables) for b in variables[i:]]
    labels = F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b")) for a, b in names])
    zipped = F.arrays_zip(labels.alias("pair"), F.col("covs"))
    return (moments(df, variables, keys).select(*keys, "n", F.explode(zipped).alias("m"))
            .select(*keys, "m.pair.var_a", "m.pair.var_b", "n", F.col("m.covs").alias("covariance")))


def square(upper: np.ndarray, p: int) -> np.ndarray:
    full = np.zeros((p, p))
    full[np.triu_indices(p)] = upper
    return full + np.triu(full, 1).T


def scaled_pinv(cov: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Pseudo-inverse of a covariance; directions without variance relative to `scale` are dropped."""
    var = np.diag(cov).copy()
    flat = var <= 1e-24 * np.maximum(scale ** 2, 1e-300)
    d = np.sqrt(np.where(flat, 1.0, var))
    corr = cov / np.outer(d, d)
    corr[flat, :] = 0.0
    corr[:, flat] = 0.0
    return np.linalg.pinv(corr, rcond=RCOND, hermitian=True) / np.outer(d, d)


def fit(n: float, mean: np.ndarray, cov: np.ndarray, xs: list[int], y: int, k: int):
    """Slopes, their covariance, intercept, its error, SSE and SST for y on the variables xs and a constant."""
    inv = scaled_pinv(cov[np.ix_(xs, xs)], mean[xs])
    slopes = inv @ cov[xs, y]
    sst = n * cov[y, y]
    sse = max(n * (cov[y, y] - slopes @ cov[xs, y]), 0.0)
    s2 = sse / (n - k) if n > k else np.nan
    v = s2 * inv / n
    intercept = mean[y] - slopes @ mean[xs]
    intercept_se = np.sqrt(s2 / n + mean[xs] @ v @ mean[xs])
    return slopes, v, intercept, intercept_se, sse, sst


def ols(df: DataFrame, y: str, xs: list[str], keys: list[str]) -> DataFrame:
    """Long table of coefficients: (keys, term, estimate, se, t, p, n, r2)."""
    terms = ["intercept", *xs]
    k = len(terms)

    @F.pandas_udf(record(estimate="doubles", se="doubles", t="doubles", p="doubles", r2="double"))
    def solve(n: pd.Series, means: pd.Series, covs: pd.Series) -> pd.DataFrame:
        rows = []
        for n_i, mean, upper in zip(n, means, covs):
            mean, cov = np.asarray(mean, float), square(np.asarray(upper, float), k)
            b, v, b0, se0, sse, sst = fit(n_i, mean, cov, list(range(k - 1)), k - 1, k)
            est = np.concatenate([[b0], b])
            se = np.concatenate([[se0], np.sqrt(np.maximum(np.diag(v), 0.0))])
            with np.errstate(all="ignore"):
                t = np.where(se > 0, est / np.where(se > 0, se, 1.0), np.nan)
            rows.append((est, se, t, t_tail(t, n_i - k), 1 - sse / sst if sst > 0 else np.nan))
        return pd.DataFrame(rows, columns=["estimate", "se", "t", "p", "r2"])

    solved = moments(df, [*xs, y], keys).withColumn("fit", solve("n", "means", "covs"))
    labels = F.array(*[F.lit(t) for t in terms])
    return solved.select(*keys, "n", "fit.r2", F.inline(F.arrays_zip(
        labels.alias("term"), F.col("fit.estimate").alias("estimate"), F.col("fit.se").alias("se"),
        F.col("fit.t").alias("t"), F.col("fit.p").alias("p"))))


def robust_ols(df: DataFrame, y: str, xs: list[str], keys: list[str], instruments: list[str] | None = None) -> DataFrame:
    """Coefficients with heteroskedasticity-robust errors: (keys, term, estimate, se_hc0, se_hc1, t, p, n).

    The sandwich inv(Z'Z) Z' diag(e^2) Z inv(Z'Z) in two passes: moments give the coefficients, then each row's squared residual
    weighs the cross products of its regressors about their means, which again combine on the map side. With `instruments`
    (as many as xs, in their order; an exogenous regressor is its own) the estimates are two-stage least squares, Z the fitted
    regressors, residuals those of the actual ones. Rows with a NULL variable are left out.
    """
    terms = ["intercept", *xs]
    k = len(xs)
    zs = instruments or xs
    variables = [*dict.fromkeys([*xs, *zs]), y]
    place = {v: i for i, v in enumerate(variables)}
    x_at, z_at, y_at = [place[v] for v in xs], [place[v] for v in zs], place[y]

    @F.pandas_udf(record(slopes="doubles", first="doubles", inverse="doubles"))
    def solve(n: pd.Series, means: pd.Series, covs: pd.Series) -> pd.DataFrame:
        rows = []
        for mean, upper in zip(means, covs):
            mean, cov = np.asarray(mean, float), square(np.asarray(upper, float), len(variables))
            first = scaled_pinv(cov[np.ix_(z_at, z_at)], mean[z_at]) @ cov[np.ix_(z_at, x_at)]  # z -> fitted x
            inv = scaled_pinv(first.T @ cov[np.ix_(z_at, z_at)] @ first, mean[x_at])
            slopes = inv @ first.T @ cov[z_at, y_at]
            rows.append((slopes, first.T.ravel(), inv.ravel()))
        return pd.DataFrame(rows, columns=["slopes", "first", "inverse"])

    solved = moments(df, variables, keys).filter(F.col("n") > 0).withColumn("fit", solve("n", "means", "covs")).select(
        *keys, "n", "means", "fit.*")
    whole = reduce(and_, [F.col(v).isNotNull() for v in variables])
    rows = df.select(*keys, *[F.col(v).cast("double").alias(v) for v in variables]).filter(whole)
    same = [F.col(f"k{i}_") for i, _ in enumerate(keys)]
    named = solved.withColumnsRenamed({c: f"k{i}_" for i, c in enumerate(keys)})
    met = rows.join(named, reduce(and_, [rows[c].eqNullSafe(s) for c, s in zip(keys, same)]))

    def about(v: str):
        return F.col(v) - F.col("means")[place[v]]

    residual = about(y) - sum((F.col("slopes")[i] * about(x) for i, x in enumerate(xs)), F.lit(0.0))
    design = [sum((F.col("first")[i * k + j] * about(z) for j, z in enumerate(zs)), F.lit(0.0)) for i in range(k)]
    named_rows = met.select(*keys, "n", "means", "slopes", "inverse", (residual * residual).alias("e2_"), *[d.alias(f"d{i}_") for i, d in enumerate(design)])
    full = [F.lit(1.0), *[F.col(f"d{i}_") for i in range(k)]]
    meat = F.array(*[F.sum(F.col("e2_") * full[i] * full[j]) for i in range(k + 1) for j in range(i, k + 1)])
    summed = named_rows.groupBy(*keys).agg(F.first("n").alias("n"), F.first("means").alias("means"), F.first("slopes").alias("slopes"),
                                           F.first("inverse").alias("inverse"), meat.alias("meat"))

    @F.pandas_udf(record(estimate="doubles", hc0="doubles", hc1="doubles", t="doubles", p="doubles"))
    def errors(n: pd.Series, means: pd.Series, slopes: pd.Series, inverse: pd.Series, meat: pd.Series) -> pd.DataFrame:
        out = []
        for n_i, centre, b, inv, m in zip(n, means, slopes, inverse, meat):
            centre, b = np.asarray(centre, float), np.asarray(b, float)
            bread = np.zeros((k + 1, k + 1))  # of the centred design with a constant
            bread[0, 0], bread[1:, 1:] = 1 / n_i, np.asarray(inv, float).reshape(k, k) / n_i
            v = bread @ square(np.asarray(m, float), k + 1) @ bread
            turn = np.eye(k + 1)
            turn[0, 1:] = -centre[x_at]
            v = turn @ v @ turn.T
            est = np.concatenate([[centre[y_at] - b @ centre[x_at]], b])
            hc0 = np.sqrt(np.maximum(np.diag(v), 0.0))
            hc1 = hc0 * np.sqrt(n_i / (n_i - k - 1)) if n_i > k + 1 else np.full(k + 1, np.nan)
            with np.errstate(all="ignore"):
                t = np.where(hc1 > 0, est / np.where(hc1 > 0, hc1, 1.0), np.nan)
            out.append((est, hc0, hc1, t, t_tail(t, n_i - k - 1)))
        return pd.DataFrame(out, columns=["estimate", "hc0", "hc1", "t", "p"])

    fitted = summed.withColumn("fit", errors("n", "means", "slopes", "inverse", "meat"))
    labels = F.array(*[F.lit(t) for t in terms])
    return fitted.select(*keys, "n", F.inline(F.arrays_zip(
        labels.alias("term"), F.col("fit.estimate").alias("estimate"), F.col("fit.hc0").alias("se_hc0"), F.col("fit.hc1").alias("se_hc1"),
        F.col("fit.t").alias("t"), F.col("fit.p").alias("p"))))


def simple_ols(y: Column, x: Column) -> list[Column]:
    """Slope regression with one regressor as plain aggregates: n, slope, intercept, slope_se, r2."""
    n = F.regr_count(y, x)
    sse = F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)
    return [n.alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            F.sqrt(F.try_divide(sse, (n - 2) * F.regr_sxx(y, x))).alias("slope_se"), F.regr_r2(y, x).alias("r2")]
