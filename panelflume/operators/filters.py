"""Row selection: splits by position, tails, observation gates, presence-tolerant column lists."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume.operators.blocks import with_positions

# One series has at most one row per period, so a window over one entity is bounded by the calendar, not by the
# number of source rows. `blocks.py` has the form for series that are longer than one task should hold.


def series_window(entity: str = "route", time: str = "date"):
    return Window.partitionBy(entity).orderBy(time)


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def missing(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def date_window(column: Column, centre: Column, before_weeks, after_weeks) -> Column:
    """Predicate for centre-before .. centre+after weeks, both ends included."""
    before, after = (F.lit(v) if isinstance(v, int) else v for v in (before_weeks, after_weeks))
    return column.between(F.date_sub(centre, before * 7), F.date_add(centre, after * 7))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Lags and folds assume none for (route, date)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def min_observations(df: DataFrame, least: int, entity: str = "route") -> DataFrame:
    """Rows of entities with at least `least` rows, in one pass over df."""
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(entity)))
    return counted.filter(F.col("_n") >= least).drop("_n")


def numbered(df: DataFrame, entity: str = "route", time: str = "date", bucket: Column | None = None) -> DataFrame:
    """Add position (1-based, by time) and n_rows of the entity.

    With a bucket (an expression that does not decrease with time, e.g. the year) both come from counts per
    (entity, bucket), and no task holds a whole entity.
    """
    if bucket is None:
        return (df.withColumn("position", F.row_number().over(series_window(entity, time)))
                .withColumn("n_rows", F.count(F.lit(1)).over(Window.partitionBy(entity))))
    sizes = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"))
    placed = with_positions(df, bucket, entity, time).withColumn("position", (F.col("position") + 1).cast("int"))
    return placed.join(sizes, entity)


def holdout_split(df: DataFrame, test_rows: int, entity: str = "route", time: str = "date",
                  bucket: Column | None = None) -> DataFrame:
    """Add position, n_rows and period: the last test_rows of each entity are 'test'."""
    last = F.col("position") > F.col("n_rows") - test_rows
    return numbered(df, entity, time, bucket).withColumn("period", F.when(last, "test").otherwise("train"))


def tail(df: DataFrame, rows: int, entity: str = "route", time: str = "date", bucket: Column | None = None) -> DataFrame:
    """Last rows of each entity."""
    if bucket is not None:
        kept = numbered(df, entity, time, bucket).filter(F.col("position") > F.col("n_rows") - rows)
        return kept.drop("position", "n_rows")
    rank = F.row_number().over(Window.partitionBy(entity).orderBy(F.col(time).desc()))
    return df.withColumn("_from_end", rank).filter(F.col("_from_end") <= rows).drop("_from_end")


def walk_forward(df: DataFrame, folds: int, fold_rows: int, entity: str = "route", time: str = "date",
                 bucket: Column | None = None) -> DataFrame:
    """Expanding-window folds over the rows of each entity.

    Validation windows tile the tail; fold i trains on all rows before its window. Each row is emitted once per fold
    it belongs to (fold 1..folds, role 'train' or 'val').
    """
    placed = (
        numbered(df, entity, time, bucket)
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("_from", F.col("n_rows") - (F.lit(folds + 1) - F.col("fold")) * fold_rows)
        .filter(F.col("position") <= F.col("_from") + fold_rows)
    )
    role = F.when(F.col("position") <= F.col("_from"), "train").otherwise("val")
    return placed.withColumn("role", role).drop("position", "n_rows", "_from")
