"""Filling of missing values in dense series: carried forward, on a line, or from the season before, over gaps up to a limit."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume.operators.blocks import with_positions

POLICIES = ("forward", "linear", "seasonal")


def _placed(df: DataFrame, entity: str, time: str, bucket: Column | None, reach: int, block_rows: int):
    """df with pos_ and the window of a series, or of a block with `reach` rows on either side of it (own_ marks the block's own)."""
    if bucket is None:
        w = Window.partitionBy(entity).orderBy(time)
        return df.withColumn("pos_", F.row_number().over(w).cast("long")).withColumn("own_", F.lit(True)), Window.partitionBy(entity).orderBy("pos_")
    size = max(block_rows, reach)
    placed = with_positions(df, bucket, entity, time).withColumnRenamed("position", "pos_")
    first, last = F.floor((F.col("pos_") - reach) / size), F.floor((F.col("pos_") + reach) / size)
    spread = placed.withColumn("block_", F.explode(F.sequence(F.greatest(first, F.lit(0).cast("long")), last)))
    return spread.withColumn("own_", F.floor(F.col("pos_") / size) == F.col("block_")), Window.partitionBy(entity, "block_").orderBy("pos_")


def fill(df: DataFrame, columns: dict[str, str], limit: int, season: int = 52, entity: str = "route", time: str = "date",
         bucket: Column | None = None, block_rows: int = 1 << 14) -> DataFrame:
    """df, one row per period, with missing values of the columns filled by their policy.

    forward: the last value, at most `limit` periods old. linear: on the line between the values around a gap of at most `limit`
    periods. seasonal: the value one season earlier, at most `limit` periods after the last value. What a policy can't fill stays
    missing. With a bucket (which does not decrease with time) rows are dealt to blocks that see `limit` rows, or a season, beyond
    their ends, so that no task holds a whole series; the result is the same.
    """
    unknown = {p for p in columns.values() if p not in POLICIES}
    if unknown:
        raise ValueError(f"unknown policies {sorted(unknown)}")
    reach = max([limit + 1, *[season for p in columns.values() if p == "seasonal"]])
    rows, w = _placed(df, entity, time, bucket, reach, block_rows)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    filled = {}
    for c, policy in columns.items():
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("pos_").alias("p")))
        last, following = F.last(known, True).over(before), F.first(known, True).over(after)
        age = F.col("pos_") - last["p"]
        if policy == "forward":
            value = F.when(age <= limit, last["v"])
        elif policy == "linear":
            width = following["p"] - last["p"]
            value = F.when(width <= limit + 1, last["v"] + (following["v"] - last["v"]) * age / width)
        else:
            value = F.when(age <= limit, F.lag(c, season).over(w))
        filled[c] = F.coalesce(F.col(c), value)
    names = [F.col(c) for c in df.columns]
    return rows.withColumns({f"filled_{c}": v for c, v in filled.items()}).filter("own_").select(
        *[F.col(f"filled_{c}").alias(c) if c in filled else n for c, n in zip(df.columns, names)])
