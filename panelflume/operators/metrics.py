"""Forecast accuracy and summary aggregates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

EPS = 2.220446049250313e-16


def mape(y: Column, f: Column) -> Column:
    """Mean absolute percentage error, as a fraction."""
    return F.avg(F.abs(y - f) / F.greatest(F.abs(y), F.lit(EPS)))


def rmse(y: Column, f: Column) -> Column:
    return F.sqrt(F.avg((y - f) * (y - f)))


def r2(y: Column, f: Column) -> Column:
    """1 - SSE/SST; NULL when y is constant."""
    return F.lit(1.0) - F.try_divide(F.sum((y - f) * (y - f)), F.var_pop(y) * F.count(y))


def percentiles(df: DataFrame, value: str, shares: list[float], *keys: str, accuracy: int | None = None) -> DataFrame:
    """Per key an array of percentiles, linearly interpolated. Given an accuracy they come from a sketch of bounded size instead
    (relative rank error 1 / accuracy), for groups too large to sort."""
    at = F.array(*[F.lit(s) for s in shares])
    column = F.percentile(value, at) if accuracy is None else F.percentile_approx(F.col(value).cast("double"), at, accuracy)
    return df.groupBy(*keys).agg(column.alias("percentiles"))


def exact_sum(name: str, scale: int = 4) -> Column:
    """Sum of amounts with a fixed number of decimals; the same for any order of the rows."""
    return F.sum(F.col(name).cast(f"decimal(28,{scale})")).cast("double")


def improvement_pct(base: Column, better: Column) -> Column:
    return F.try_divide(base - better, base) * F.lit(100.0)


def standardise(df: DataFrame, columns: list[str], entity: str = "route") -> DataFrame:
    """(x - mean) / population deviation per entity; a constant column is only centred. One pass over df."""
    w = Window.partitionBy(entity)
    stats = {f"_s_{c}": F.stddev_pop(c).over(w) for c in columns} | {f"_m_{c}": F.avg(c).over(w) for c in columns}
    scaled = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))
              for c in columns}
    return df.withColumns(stats).withColumns(scaled).drop(*stats)


def forecast_metrics(df: DataFrame) -> DataFrame:
    """Metrics row per route from a table (route, period, actual, hw_fc, hybrid_fc)."""
    test = F.col("period") == "test"
    y, hw, hy = (F.when(test, F.col(c).cast("double")) for c in ("actual", "hw_fc", "hybrid_fc"))
    base = df.groupBy("route").agg(
        F.count_if(~test).alias("n_train"), F.count_if(test).alias("n_test"),
        mape(y, hw).alias("hw_mape"), mape(y, hy).alias("hybrid_mape"),
        rmse(y, hy).alias("hybrid_rmse"), r2(y, hy).alias("hybrid_r2"),
    )
    return base.withColumn("mape_improvement_pct", improvement_pct(F.col("hw_mape"), F.col("hybrid_mape")))


def round_metrics(df: DataFrame) -> DataFrame:
    digits = {"hw_mape": 4, "hybrid_mape": 4, "hybrid_rmse": 2, "hybrid_r2": 4, "mape_improvement_pct": 2,
              "cv_mape_mean": 4, "cv_mape_std": 4, "adf_t_stat": 4, "adf_p": 4}
    return df.withColumns({c: F.bround(c, d) for c, d in digits.items() if c in df.columns})


def share_of_max(df: DataFrame, value: str, entity: str = "route") -> DataFrame:
    return df.withColumn("share_of_max", F.try_divide(F.col(value), F.max(value).over(Window.partitionBy(entity))))


def top_per_group(df: DataFrame, value: str, k: int, entity: str = "route", tie: str = "feature_code") -> DataFrame:
    w = Window.partitionBy(entity).orderBy(F.col(value).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def monthly(df: DataFrame) -> DataFrame:
    return df.groupBy("route", F.trunc("date", "month").alias("month_start")).agg(
        F.sum("pax").alias("pax"), exact_sum("revenue").alias("revenue"))
