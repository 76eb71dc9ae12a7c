"""Panel features: lags, rolling statistics, encodings, flags and interactions.

All windowed columns share one partitioning and one sort, so the whole frame costs a single exchange on the entity.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import clip, cyclic_cos, cyclic_sin, growth
from panelflume.operators.blocks import with_halo, with_positions
from panelflume.operators.filters import missing, series_window

LAGS = (4, 8, 13, 52)


def lag_columns(w) -> dict[str, Column]:
    columns = {f"pax_lag{k}": F.lag("pax", k).over(w) for k in LAGS}
    columns["yield_lag4"] = F.lag("yield_aud", 4).over(w)
    return columns


def rolling_columns(w, leak_free: bool = False) -> dict[str, Column]:
    """Trailing statistics over the last 4 and 13 rows, current row included unless leak_free."""
    last = -1 if leak_free else 0
    four, thirteen = w.rowsBetween(last - 3, last), w.rowsBetween(last - 12, last)
    return {
        "rolling_mean_4w": F.avg("pax").over(four),
        "rolling_std_4w": F.coalesce(F.stddev_samp("pax").over(four), F.lit(0.0)),
        "rolling_mean_13w": F.avg("pax").over(thirteen),
    }


def calendar_columns(base_year: int = fv.BASE_YEAR) -> dict[str, Column]:
    month = F.col("month")
    return {
        "week_sin": cyclic_sin(F.col("week_of_year"), fv.SEASON_WEEKS),
        "week_cos": cyclic_cos(F.col("week_of_year"), fv.SEASON_WEEKS),
        "month_sin": cyclic_sin(month, 12),
        "month_cos": cyclic_cos(month, 12),
        "is_summer": month.isin(12, 1, 2).cast("int"),
        "is_winter": month.isin(6, 7, 8).cast("int"),
        "year_idx": F.col("year") - base_year,
    }


def derived_columns(leak_free: bool = False) -> dict[str, Column]:
    """Columns computed from lags and rolling statistics. The leak-free form reads the previous row's target."""
    current = F.col("_previous") if leak_free else F.col("pax")
    return {
        "pax_yoy_growth": clip(growth(current, F.col("pax_lag52")), -1.0, 5.0),
        "pax_vs_rolling": growth(current, F.col("rolling_mean_4w")),
    }


def interaction_columns() -> dict[str, Column]:
    return {
        "comp_x_biz": F.col("competition_index") * F.col("business_mix"),
        "rate_x_biz": F.col("rba_cash_rate") * F.col("business_mix"),
        "fuel_x_yield": F.col("fuel_index") / F.lit(100) * F.col("yield_aud"),
        "covid_x_school": F.col("covid_factor") * F.col("school_holiday"),
    }


def add_features(df: DataFrame, drop_na: bool = True, leak_free: bool = False, base_year: int = fv.BASE_YEAR,
                 block_rows: int | None = None) -> DataFrame:
    """Append every feature the input columns allow.

    drop_na drops rows without a lag-52 value. block_rows switches to halo blocks, for entities with more rows than
    one task should sort.
    """
    if block_rows is None:
        w = series_window()
        source = df
    else:
        numbered = with_positions(df, F.year("date"))
        source = with_halo(numbered, max(LAGS) + 1, block_rows)
        w = Window.partitionBy("route", "block").orderBy("position")
    windowed = {**lag_columns(w), **rolling_columns(w, leak_free)}
    if leak_free:
        windowed["_previous"] = F.lag("pax", 1).over(w)
    out = source.withColumns(windowed)
    if block_rows is not None:
        out = out.filter(~F.col("is_halo")).drop("is_halo", "block", "position")
    out = out.withColumns({**calendar_columns(base_year), **derived_columns(leak_free)})
    inputs = ["competition_index", "business_mix", "rba_cash_rate", "fuel_index", "covid_factor", "school_holiday"]
    if not missing(out, inputs):
        out = out.withColumns(interaction_columns())
    out = out.drop("_previous")
    return out.dropna(subset=["pax_lag52"]) if drop_na else out


def differences(df: DataFrame, lags: int, value: str = "pax") -> DataFrame:
    """First difference `dy`, previous level `y_prev`, and dy_lag1..dy_lag<lags>, over one window sort."""
    w = series_window()
    first = df.withColumns({"y_prev": F.lag(value, 1).over(w), "dy": F.col(value) - F.lag(value, 1).over(w)})
    return first.withColumns({f"dy_lag{i}": F.lag("dy", i).over(w) for i in range(1, lags + 1)}) if lags else first
