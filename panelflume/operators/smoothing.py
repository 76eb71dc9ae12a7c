"""Additive Holt-Winters smoothing of many series at once.

Smoothing is sequential in time, so one series is one array and series are the unit of distribution. The array of a
series has one entry per period. The recursion runs in Arrow batches, vectorised over the parameter sets.
"""
from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.shapes import record

GRID = np.array(list(itertools.product(fv.ALPHA_GRID, fv.BETA_GRID, fv.GAMMA_GRID)))


def by_entity(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows by key into the session's number of shuffle partitions.

    Adaptive execution would merge partitions by their bytes; a series is few bytes but much work, so the number is
    kept. Grouping by the same keys needs no further exchange.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def series(df: DataFrame, value: str = "pax", carry: list[str] | None = None) -> DataFrame:
    """One row per route: `rows` array<struct<date, carry...>> in time order and `y` array<double>."""
    packed = F.struct("date", F.col(value).cast("double").alias("y"), *(carry or []))
    rows = by_entity(df.select("route", "date", value, *(carry or [])), "route").groupBy("route").agg(F.array_sort(F.collect_list(packed)).alias("rows"))
    return rows.withColumn("y", F.transform("rows", lambda r: r["y"]))


def smooth(df: DataFrame, alpha: float, beta: float, gamma: float, season: int,
           one_step_ahead: bool = False) -> DataFrame:
    """Add `state`: arrays level, trend, seasonal and fitted for the array column y, in time linear in its length.

    The level starts at the first season's mean and the trend at the mean step between the first two seasons; with
    less than two seasons they start at the first value and the mean step. Before one full season has passed the
    seasonal term is zero. fitted uses the level after the value was seen; one_step_ahead uses the state before it.
    """
    params = np.array([[alpha, beta, gamma]])

    @F.pandas_udf(record(level="doubles", trend="doubles", seasonal="doubles", fitted="doubles"))
    def run(y: pd.Series) -> pd.DataFrame:
        rows = []
        for v in y:
            level, trend, seasonal, fitted = (a[:, 0] for a in states(np.asarray(v, float), params, season))
            if one_step_ahead and len(level):
                fitted = np.concatenate((fitted[:1], level[:-1] + trend[:-1] + previous_season(seasonal, season)[1:]))
            rows.append({"level": level, "trend": trend, "seasonal": seasonal, "fitted": fitted})
        return pd.DataFrame(rows, columns=["level", "trend", "seasonal", "fitted"])

    return df.withColumn("state", run("y"))


def fitted_rows(smoothed: DataFrame, season: int) -> DataFrame:
    """Long components: route, date, y, level, trend, seasonal, fitted, residual.

    The seasonal component of a period is the index one season earlier, or the first index within the first season.
    """
    lagged = F.transform(F.sequence(F.lit(0), F.size("y") - 1), lambda i: F.get(
        F.col("state.seasonal"), F.greatest(i - season, F.lit(0))))
    zipped = F.arrays_zip(F.col("rows"), F.col("state.level").alias("level"), F.col("state.trend").alias("trend"),
                          lagged.alias("seasonal"), F.col("state.fitted").alias("fitted"))
    long = smoothed.select("route", F.explode(zipped).alias("r"))
    return long.select("route", "r.rows.date", "r.rows.y", "r.level", "r.trend", "r.seasonal", "r.fitted",
                       (F.col("r.rows.y") - F.col("r.fitted")).alias("residual"))


def forecast_rows(smoothed: DataFrame, steps: int, season: int) -> DataFrame:
    """Long forecasts: route, step 1..steps, hw_fc (not floored)."""
    n = F.size("y")
    last_level = F.element_at("state.level", -1)
    last_trend = F.element_at("state.trend", -1)
    index = n - season + (F.col("step") - 1) % season
    seasonal = F.when(index >= 0, F.coalesce(F.get(F.col("state.seasonal"), index), F.lit(0.0))).otherwise(0.0)
    return (smoothed.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
            .select("route", "step", (last_level + F.col("step") * last_trend + seasonal).alias("hw_fc")))


# Grid search -----------------------------------------------------------------------------------------------------

def opening(y: np.ndarray, season: int) -> tuple[float, float, float]:
    """Level, trend and seasonal term of the first period."""
    n = len(y)
    if n >= 2 * season:
        one, two = y[:season].mean(), y[season:2 * season].mean()
        level, trend = one, (two - one) / season
    else:
        level, trend = y[0], (y[-1] - y[0]) / max(n - 1, 1)
    return level, trend, (y[0] - level if n >= season else 0.0)


def passes(y: np.ndarray, grid: np.ndarray, season: int):
    """(level, trend, seasonal, fitted) of every period for all parameter sets side by side. Only a ring of one season is kept."""
    alpha, beta, gamma = grid.T
    level, trend, first = (np.full(len(grid), v) for v in opening(y, season))
    ring = np.zeros((season, len(grid)))
    ring[0] = first
    yield level, trend, first, level + trend + first
    for t in range(1, len(y)):
        was = ring[t % season].copy() if t >= season else 0.0
        up = alpha * (y[t] - was) + (1 - alpha) * (level + trend)
        trend = beta * (up - level) + (1 - beta) * trend
        level = up
        now = gamma * (y[t] - level) + (1 - gamma) * was
        ring[t % season] = now
        yield level, trend, now, level + trend + was


def previous_season(seasonal: np.ndarray, season: int) -> np.ndarray:
    """The seasonal term one season earlier, zero in the first season."""
    return np.concatenate((np.zeros(min(season, len(seasonal))), seasonal[:-season]))[:len(seasonal)]


def states(y: np.ndarray, grid: np.ndarray, season: int) -> list[np.ndarray]:
    """Level, trend, seasonal index and fitted values, each of shape (periods, parameter sets)."""
    if not len(y):
        return [np.zeros((0, len(grid)))] * 4
    return [np.array(part) for part in zip(*passes(y, grid, season))]


def best_fit(y: np.ndarray, season: int, grid: np.ndarray = GRID) -> dict:
    """Grid point of least in-sample error, earliest on ties, with its state: errors of all points first, then the state of
    the best."""
    with np.errstate(all="ignore"):
        square = sum(((v - fitted) ** 2 for v, (_, _, _, fitted) in zip(y, passes(y, grid, season))), np.zeros(len(grid)))
        error = np.sqrt(square / len(y))
        if np.isfinite(error).any():
            params = grid[[int(np.argmin(np.where(np.isfinite(error), error, np.inf)))]]
        else:
            params = np.array([fv.FALLBACK_PARAMS])
        level, trend, seasonal, fitted = (a[:, 0] for a in states(y, params, season))
        rmse = np.sqrt(np.mean((y - fitted) ** 2))
    return {"alpha": params[0, 0], "beta": params[0, 1], "gamma": params[0, 2], "rmse": rmse,
            "level": level, "trend": trend, "seasonal": seasonal, "fitted": fitted}


_FIT_TYPE = record(alpha="double", beta="double", gamma="double", rmse="double", level="doubles", trend="doubles",
                   seasonal="doubles", fitted="doubles")


def grid_fit(df: DataFrame, season: int = fv.SEASON_WEEKS) -> DataFrame:
    """Add alpha, beta, gamma, rmse and `state` (as in `smooth`) for the array column y.

    Series arrive spread over tasks by the grouping that built them; a batch holds whole series.
    """
    @F.pandas_udf(_FIT_TYPE)
    def run(y: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_fit(np.asarray(v, float), season) for v in y])

    fitted = df.withColumn("_fit", run("y"))
    state = F.struct(*[F.col(f"_fit.{f}").alias(f) for f in ("level", "trend", "seasonal", "fitted")])
    return fitted.select(*df.columns, "_fit.alpha", "_fit.beta", "_fit.gamma", "_fit.rmse", state.alias("state"))


def decomposition(components: DataFrame, last: int = 2 * fv.SEASON_WEEKS) -> DataFrame:
    """Last periods of each route as one row of parallel arrays."""
    packed = F.array_sort(F.collect_list(F.struct("date", "y", "level", "trend", "seasonal", "residual")))
    rows = components.groupBy("route").agg(packed.alias("_all"))
    kept = rows.withColumn("_r", F.slice("_all", F.greatest(F.size("_all") - last + 1, F.lit(1)), last))
    return kept.select(
        "route", F.transform("_r", lambda r: F.date_format(r["date"], "yyyy-MM-dd")).alias("dates"),
        F.col("_r.y").alias("pax"), *[F.col(f"_r.{c}").alias(c) for c in ("level", "trend", "seasonal", "residual")])
