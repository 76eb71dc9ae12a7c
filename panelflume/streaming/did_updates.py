"""Difference-in-differences kept current while rows arrive.

Moments of disjoint rows merge, so the stream keeps no state: each micro-batch is reduced to its own moments, one row per
experiment, arm and date, in a folder named by the batch and written again under the same name if the batch is retried.
Estimates merge the moments of all written batches. compact() merges them on disk.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelflume.operators import did


def maintain(rows: DataFrame, specs: DataFrame, outcomes: list[str], folder: str):
    """Start (or resume) the stream over `rows` until the available input is used up. Returns the streaming query.

    rows is a streaming DataFrame with route, date and the outcome columns. Progress is kept in folder/progress.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        did.moments(batch, specs, outcomes).write.mode("overwrite").parquet(f"{folder}/moments/batch={batch_id}")

    return (rows.writeStream.foreachBatch(store)
            .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start())


def moments(spark: SparkSession, folder: str) -> DataFrame:
    """The moments of all batches written so far, in any run, merged."""
    return did.merge_moments(spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/moments"))


def estimates(spark: SparkSession, folder: str) -> DataFrame:
    return did.fit_tests(moments(spark, folder))


def compact(spark: SparkSession, folder: str, into: str) -> None:
    """Write the merged moments to a new folder, with the progress, so that a stream on that folder goes on after the last batch merged.
    Nothing is deleted; no stream may run on `folder` meanwhile."""
    moments(spark, folder).write.parquet(f"{into}/moments/batch=base")
    copied(spark, f"{folder}/progress", f"{into}/progress")


def copied(spark: SparkSession, source: str, target: str) -> None:
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    a, b = hadoop.Path(source), hadoop.Path(target)
    hadoop.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
