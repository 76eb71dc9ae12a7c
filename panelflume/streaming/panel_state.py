"""Daily moments of a panel kept as the state of a stream, and difference-in-differences read from what it has put out.

Rows are grouped by route and a window of one day. The state holds the days that can still change: those within `lateness`
of the latest row seen. Older days leave the state, and rows for them are late and dropped. Each micro-batch puts out the
present totals of the days it changed, under its own number; the latest totals of a day count, so a batch that is run again, or a
compaction, changes nothing. Experiments are met when the totals are read and may be set up at any time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume.operators import did, did_rolling


def keep(rows: DataFrame, outcomes: list[str], folder: str, lateness: str = "90 days", key: list[str] | None = None):
    """Start (or resume) the stream over rows (route, date, outcomes), a streaming DataFrame, until the available input is used up.

    key: columns that name a row; a row that comes again within `lateness` is dropped.
    """
    timed = rows.filter(F.col("date").isNotNull()).withColumn("at_", F.col("date").cast("timestamp")).withWatermark("at_", lateness)
    if key:
        timed = timed.dropDuplicatesWithinWatermark(key)
    days = timed.groupBy(F.window("at_", "1 day").alias("day_"), "route").agg(did.day_moments(outcomes))
    totals = days.select("route", F.col("day_.start").cast("date").alias("date"), "_moments")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/totals/batch={batch_id}")

    return (totals.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start())


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """The latest totals of every route and day: route, date, _moments, batch."""
    every = spark.read.parquet(f"{folder}/totals")
    latest = every.groupBy("route", "date").agg(F.max_by(F.struct("_moments", "batch"), "batch").alias("last"))
    return latest.select("route", "date", "last._moments", "last.batch")


def estimates(spark: SparkSession, folder: str, specs: DataFrame) -> DataFrame:
    return did.fit_tests(did.meet(totals(spark, folder).drop("batch"), specs))


def rolling(spark: SparkSession, folder: str, specs: DataFrame, pre_weeks: int, post_weeks: int, every: int = 1) -> DataFrame:
    """Estimates for every date of a Monday grid whose window the days seen so far fill, see did_rolling.rolling()."""
    return did_rolling.rolling(totals(spark, folder).drop("batch"), specs, pre_weeks, post_weeks, every)


def compact(spark: SparkSession, folder: str) -> None:
    """Gathers the latest totals in the folder of the last batch and removes those of older ones. The stream goes on where it was:
    its progress is not touched, and later batches have larger numbers. No stream may run on `folder` meanwhile."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    top = hadoop.Path(f"{folder}/totals")
    files = top.getFileSystem(conf)
    old = sorted((s.getPath() for s in files.listStatus(top) if s.getPath().getName().startswith("batch=")),
                 key=lambda p: int(p.getName()[len("batch="):]))
    if len(old) < 2:
        return
    fresh = hadoop.Path(f"{folder}/compacted")
    files.delete(fresh, True)
    totals(spark, folder).drop("batch").write.parquet(fresh.toString())
    last = old[-1].getName()
    for path in old[::-1]:  # the last first: until the new one stands, the older ones may repeat what it held
        if path.getName() == last:
            files.rename(path, hadoop.Path(f"{folder}/replaced"))
            files.rename(fresh, path)
            files.delete(hadoop.Path(f"{folder}/replaced"), True)
        else:
            files.delete(path, True)
