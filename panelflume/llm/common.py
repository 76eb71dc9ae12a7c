"""Helpers the corpus operators share: scratch tables, column sealing, joins against skewed keys, Bloom bitmaps."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, or under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def saved(df: DataFrame, rebalance: bool = False) -> DataFrame:
    """df written to the shared scratch folder and read back: computed once, and it outlives executors."""
    folder = scratch(df.sparkSession)
    (df.hint("rebalance") if rebalance else df).write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.scratch_folder = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the folders of saved() tables that nothing reads any more: everything made from them has been written."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_folder)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sealed(df: DataFrame, prefix: str = "c") -> tuple[DataFrame, dict[str, str]]:
    """df with its columns renamed by position, so that no input column can clash with a working column.

    The dictionary maps each old name to its new one; opened() turns them back.
    """
    names = {name: f"{prefix}{i}_" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def opened(df: DataFrame, names: dict[str, str], *extra: Column) -> DataFrame:
    return df.select(*[F.col(new).alias(old) for old, new in names.items()], *extra)


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def salt(salts: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def attach(rows: DataFrame, values: DataFrame, keys: list[str], spread: list[str], salts: int = 64,
           how: str = "inner") -> DataFrame:
    """rows joined with values, which has at most one row per key, however many rows share a key.

    A key's rows are dealt to `salts` sub-keys by the columns of `spread`; a value is copied only to sub-keys in use, so
    the copies are never more than the rows. rows is read twice.
    """
    dealt = rows.withColumn("salt_", salt(salts, *[F.col(c) for c in spread]))
    used = dealt.select(*keys, "salt_").distinct()
    return dealt.join(used.join(values, keys), [*keys, "salt_"], how).drop("salt_")


def bloom(slots: DataFrame, slot: str) -> DataFrame:
    """The slots (0 and up) as bitmaps: a row for each 32,768 slots, 4 KB each."""
    at = F.col(slot) + 1
    return (slots.select(F.bitmap_bucket_number(at).alias("bucket_"), F.bitmap_bit_position(at).alias("bit_"))
            .groupBy("bucket_").agg(F.bitmap_construct_agg("bit_").alias("bitmap_")))


def bloom_hit(rows: DataFrame, slot: Column, bitmaps: DataFrame, name: str) -> DataFrame:
    """rows with a boolean column saying whether slot is set. bitmaps is broadcast: the caller's number of slots bounds
    its size (an eighth of a byte each)."""
    rows = rows.withColumn("at_", slot + 1).withColumn("bucket_", F.bitmap_bucket_number("at_"))
    hit = F.expr("bitmap_ is not null and (shiftright(cast(conv(hex(substring(bitmap_, cast((at_ - 1) % 32768 div 8 as int)"
                 " + 1, 1)), 16, 10) as int), cast((at_ - 1) % 8 as int)) & 1) = 1")
    return rows.join(F.broadcast(bitmaps), "bucket_", "left").withColumn(name, hit).drop("at_", "bucket_", "bitmap_")
