"""Exact duplicate removal: two passes over a Bloom filter, and a shuffle only for rows that may repeat."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume.llm.common import bloom, bloom_hit, opened, salt, saved, sealed

SLOTS = 1 << 26
SALTS = 256


def _slots(digest: str, slots: int) -> list[Column]:
    """Two positions of a digest, each in its own half of the filter."""
    return [F.pmod(F.xxhash64(F.col(digest), F.lit(i)), F.lit(slots)) + i * slots for i in range(2)]


def mark_copies(docs: DataFrame, text: str = "text", order: str = "doc_id", slots: int = SLOTS,
                salts: int = SALTS) -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256.

    Pass one counts how often each of two filter positions is hit, with map-side combine, and keeps the positions hit
    twice or more as bitmaps. Pass two tests every row against them: a row with a position hit once cannot repeat and goes
    straight through. The others are grouped by digest in salted parts, so that no group meets in one task. The filter
    takes slots / 4 bytes (16 MB as set) and is broadcast; with more texts than slots it lets more rows through to the
    shuffle and stays exact.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest `order` stays (null
    sorts last). Rows equal in both stay once. An empty table gives an empty result; other columns are untouched, but
    one named like a result column is replaced by it.
    """
    rows, names = sealed(docs.drop("keep_id", "group_size", "kept", "text_sha256"))
    key = names[order]
    rows = rows.withColumn("sha_", F.sha2(F.coalesce(F.col(names[text]), F.lit("")).cast("binary"), 256))
    hits = (rows.select(F.explode(F.array(*_slots("sha_", slots))).alias("slot_"))
            .groupBy("slot_").agg(F.count("*").alias("n_")).where("n_ > 1"))
    filter_ = saved(bloom(hits, "slot_"))
    tested = rows
    for i, slot in enumerate(_slots("sha_", slots)):
        tested = bloom_hit(tested, slot, filter_, f"hit{i}_")
    repeats = F.col("hit0_") & F.col("hit1_")
    single = tested.where(~repeats).withColumns({"keep_": F.col(key), "size_": F.lit(1).cast("long"), "kept_": F.lit(True)})

    maybe = tested.where(repeats).withColumn("salt_", salt(salts, F.col(key)))
    parts = saved(maybe.groupBy("sha_", "salt_").agg(F.max(key).alias("top_"), F.count("*").alias("n_")))
    whole = Window.partitionBy("sha_")
    groups = parts.select("sha_", "salt_", F.max("top_").over(whole).alias("keep_"), F.sum("n_").over(whole).alias("size_"))
    first = F.row_number().over(Window.partitionBy("sha_", "salt_").orderBy(F.col(key).desc_nulls_last())) == 1
    grouped = maybe.join(groups, ["sha_", "salt_"]).withColumn("kept_", F.col(key).eqNullSafe(F.col("keep_")) & first)
    columns = [*names.values(), "keep_", "size_", "kept_", "sha_"]
    return opened(single.select(*columns).unionByName(grouped.select(*columns)), names, F.col("keep_").alias("keep_id"),
                  F.col("size_").alias("group_size"), F.col("kept_").alias("kept"), F.col("sha_").alias("text_sha256"))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """One row of each text, with the columns of docs."""
    marked = mark_copies(docs, **options)
    clash = [c for c in docs.columns if c in ("keep_id", "group_size", "kept", "text_sha256")]
    if clash:
        safe = docs.toDF(*[f"{c}__in" if c in clash else c for c in docs.columns])
        return mark_copies(safe, **options).where("kept").select(*safe.columns).toDF(*docs.columns)
    return marked.where("kept").select(*docs.columns)
