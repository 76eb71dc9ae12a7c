"""A corpus pipeline: quality, exact and near duplicates, mixing, packing. Each stage reads what the one before wrote."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelflume.llm import exact_dedup, mixing, near_dedup, packing, quality
from panelflume.llm.common import scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts."""
    columns = docs.columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).where("good").select(*columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix; a document taken twice has two rows."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix with their places in sequences. Two copies of a document never share one."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("minhash near-dedup", near_stage),
          ("source mixing", mixing_stage), ("best-fit packing", packing_stage)]

# Fitted models and minwise hashes have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = scratch(spark)
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
