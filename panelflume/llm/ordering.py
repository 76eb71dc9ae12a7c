"""Places of rows in one order over all rows, or within each key, however many rows a key has."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelflume.llm.common import saved


def key_runs(column: pa.Array) -> np.ndarray:
    """Starts of the runs of equal values; nulls are equal to each other."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(codes[1:] != codes[:-1]) + 1)) if len(codes) else np.zeros(0, dtype=np.int64)


def range_sorted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows dealt into ranges of `columns` (nulls first) and sorted, with part_, the number of the range.

    Rows equal in all columns are told apart by their place in the input, so that any number of them spreads.
    """
    order = [F.col(c).asc_nulls_first() for c in columns] + [F.col("tie_").asc()]
    tied = rows.withColumn("tie_", F.monotonically_increasing_id())
    return tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie_").withColumn("part_", F.spark_partition_id())


def offsets(counts: DataFrame, key: str | None) -> DataFrame:
    """counts (part_, key, n) of range-sorted rows -> (part_, key, before_): rows of the key in earlier ranges, where there are any.

    Only the first key of a range can have begun earlier, so there is at most one row per range.
    """
    window = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before_", F.sum("n").over(window)).where("before_ > 0").drop("n")


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows, written, with place_: the row's place (0 and up) among its key's rows in the order of `order` (nulls first).

    Rows are dealt by range of (key, order), so a key of any size spreads. A task counts within its range; what a key has in
    earlier ranges comes from a table of at most a row per range, which is broadcast.
    """
    dealt = range_sorted(rows, [key, *order])
    at = dealt.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = key_runs(batch.column(at))
            place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
            if last is not None and last == (batch.column(at)[0].as_py(),):
                place[:starts[1] if len(starts) > 1 else n] += seen
            last, seen = (batch.column(at)[n - 1].as_py(),), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place_"])

    schema = StructType([*dealt.schema.fields, StructField("place_", LongType())])
    out = saved(dealt.mapInArrow(run, schema))
    before = offsets(out.groupBy("part_", key).agg(F.count("*").alias("n")), key)
    before = before.select(F.col("part_").alias("p_"), F.col(key).alias("k_"), "before_")
    met = out.join(F.broadcast(before), (F.col("part_") == F.col("p_")) & F.col(key).eqNullSafe(F.col("k_")), "left")
    return met.select(*rows.columns, (F.col("place_") + F.coalesce("before_", F.lit(0))).alias("place_"))
