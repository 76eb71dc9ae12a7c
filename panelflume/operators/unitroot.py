"""Augmented Dickey-Fuller unit-root test per entity."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import unit_root_p
from panelflume.operators.blocks import with_halo
from panelflume.operators.features import differences
from panelflume.operators.filters import numbered, series_window
from panelflume.operators.regression import fit, moments, square


def lag_order(n: int, max_lag: int | None = None) -> int:
    """Schwert's rule unless max_lag is given, never more than a quarter of the series."""
    rule = int(12 * (n / 100) ** 0.25) if max_lag is None else max_lag
    return min(rule, n // 4)


def lagged_rows(df: DataFrame, value: str, most: int, max_lag: int | None, bucket: Column | None, block_rows: int) -> DataFrame:
    """route, k, dy, y_prev and dy_lag1 .. dy_lag<most> of the rows that enter the test; lags beyond a route's order k are zero.

    With a bucket (an expression that does not decrease with time) series are cut into blocks whose halo holds the lags, so that no
    task holds a whole one.
    """
    rows = numbered(df.select("route", "date", F.col(value).cast("double").alias("y")), bucket=bucket)
    if bucket is None:
        w = series_window()
    else:
        halo = with_halo(rows.withColumn("position", F.col("position") - 1), most + 2, max(block_rows, most + 2))
        rows, w = halo.withColumn("position", F.col("position") + 1), Window.partitionBy("route", "block").orderBy("position")
    rule = F.floor(F.lit(12) * F.pow(F.col("n_rows") / F.lit(100.0), F.lit(0.25))) if max_lag is None else F.lit(max_lag)
    rows = rows.withColumn("k", F.least(rule, F.floor(F.col("n_rows") / 4)).cast("int"))
    rows = rows.withColumns({"dy": F.col("y") - F.lag("y").over(w), "y_prev": F.lag("y").over(w)})
    rows = rows.withColumns({f"dy_lag{i}": F.when(F.col("k") >= i, F.lag("dy", i).over(w)).otherwise(0.0) for i in range(1, most + 1)})
    kept = rows.filter(F.col("position") >= F.col("k") + 2)
    return kept.filter(~F.col("is_halo")) if bucket is not None else kept


def adf(df: DataFrame, value: str = "pax", max_lag: int | None = None, bucket: Column | None = None, block_rows: int = 1 << 14) -> DataFrame:
    """One row per route: adf_t_stat, n_lags, n_obs, adf_p, critical values and is_stationary.

    The regression of each difference on the level before it and k lagged differences comes from one aggregate of moments per
    route, which combines on the map side; Python solves a system of k + 1 unknowns. k follows from the route's number of rows;
    the longest series sets how many lags are made.
    """
    counts = df.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    longest = counts.agg(F.max("n")).first()[0] or 0
    most = lag_order(longest, max_lag)
    xs = ["y_prev", *[f"dy_lag{i}" for i in range(1, most + 1)]]
    found = moments(lagged_rows(df, value, most, max_lag, bucket, block_rows), [*xs, "dy"], ["route", "k"])

    @F.pandas_udf("double")
    def tau(n: pd.Series, k: pd.Series, means: pd.Series, covs: pd.Series) -> pd.Series:
        out = []
        for n_i, k_i, mean, upper in zip(n, k, means, covs):
            mean, cov = np.asarray(mean, float), square(np.asarray(upper, float), len(xs) + 1)
            if n_i <= k_i + 2 or n_i < fv.MIN_UNIT_ROOT_OBS or cov[0, 0] <= 0:
                out.append(np.nan)
                continue
            slopes, v, *_ = fit(float(n_i), mean, cov, list(range(k_i + 1)), len(xs), k_i + 2)
            out.append(slopes[0] / np.sqrt(v[0, 0]) if v[0, 0] > 0 else np.nan)
        return pd.Series(out)

    tested = found.select("route", F.nanvl(tau("n", "k", "means", "covs"), F.lit(None).cast("double")).alias("adf_t_stat"))
    rule = F.floor(F.lit(12) * F.pow(F.col("n") / F.lit(100.0), F.lit(0.25))) if max_lag is None else F.lit(max_lag)
    lags = F.least(rule, F.floor(F.col("n") / 4)).cast("int")
    every = counts.select("route", lags.alias("n_lags"), (F.col("n") - 1 - lags).cast("int").alias("n_obs"))
    return verdict(every.join(tested, "route", "left").select("route", "adf_t_stat", "n_lags", "n_obs"))


def verdict(df: DataFrame) -> DataFrame:
    """adf_p, critical values and is_stationary from adf_t_stat; an undefined statistic counts as a unit root."""
    out = df.withColumn("adf_p", F.coalesce(unit_root_p(F.col("adf_t_stat")), F.lit(1.0)))
    out = out.withColumns({f"critical_{k.rstrip('%')}": F.lit(v) for k, v in fv.UNIT_ROOT_CRITICAL.items()})
    return out.withColumn("is_stationary", F.col("adf_p") < 0.05)


def adf_without_lags(df: DataFrame, value: str = "pax") -> DataFrame:
    """The test with no lagged differences, as one aggregate of built-in regression functions."""
    d = differences(df, 0, value).filter(F.col("dy").isNotNull())
    y, x = F.col("dy").cast("double"), F.col("y_prev").cast("double")
    sse = F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)
    n = F.regr_count(y, x)
    agg = d.groupBy("route").agg(
        n.alias("n_obs"), F.regr_slope(y, x).alias("gamma"),
        F.sqrt(F.try_divide(sse, (n - 2) * F.regr_sxx(y, x))).alias("gamma_se"))
    return verdict(agg.withColumn("adf_t_stat", F.try_divide(F.col("gamma"), F.col("gamma_se"))))
