"""Exact positional windows over series too long for one task.

A plain window puts a whole entity in one task. Here rows are numbered through counts per (entity, time bucket), cut
into blocks of consecutive positions, and each block also receives the last `halo` rows of the block before it.
Lags and rolling frames up to `halo` rows back are then exact inside (entity, block), and a hot entity spreads over
many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_positions(df: DataFrame, bucket: Column, entity: str = "route", time: str = "date") -> DataFrame:
    """Add `position` (0-based, by time within entity). `bucket` must not decrease with time, e.g. the month."""
    marked = df.withColumn("_bucket", bucket)
    sizes = marked.groupBy(entity, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(entity).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(entity, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(entity, "_bucket").orderBy(time))
    return (
        marked.withColumn("_inside", inside)
        .join(offsets, [entity, "_bucket"])
        .withColumn("position", F.col("_offset") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_offset")
    )


def with_halo(df: DataFrame, halo: int, block_rows: int) -> DataFrame:
    """Add `block` and `is_halo`; rows within `halo` of the next block are repeated there."""
    if block_rows < halo:
        raise ValueError("a block must be at least as long as its halo")
    own = F.floor(F.col("position") / F.lit(block_rows))
    near_end = F.col("position") % F.lit(block_rows) >= F.lit(block_rows - halo)
    copies = F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        df.withColumn("_copy", F.explode(copies))
        .withColumn("block", own + F.col("_copy"))
        .withColumn("is_halo", F.col("_copy") == 1)
        .drop("_copy")
    )
