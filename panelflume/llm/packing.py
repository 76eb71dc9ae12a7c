"""Best-fit packing of documents into sequences, never putting conflicting documents into one sequence."""
from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from panelflume.llm.common import attach, saved, sealed
from panelflume.llm.near_dedup import count_words, link_documents

CAPACITY = 2048
SHARD_ROWS = 2048


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin number of each (size, source, cluster), in the order given.

    Open bins stand in order of the room left. The search starts at the first bin with enough room and goes on to the next
    tighter successor until one's bitmaps hold neither the item's source nor its cluster; else a new bin opens.
    """
    open_bins: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    source_bits: dict[int, int] = {}
    cluster_bits: dict[int, int] = {}
    for size, source, cluster in items:
        s = 1 << source_bits.setdefault(source, len(source_bits))
        c = 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        at, found = bisect_left(open_bins, (size, -1)), -1
        for i in range(at, len(open_bins)):
            b = open_bins[i][1]
            if not (sources[b] & s or clusters[b] & c):
                found = i
                break
        if found < 0:
            room, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        else:
            room, b = open_bins.pop(found)
        sources[b] |= s
        clusters[b] |= c
        if room > size:
            insort(open_bins, (room - size, b))
        out.append(b)
    return out


def pack_shard(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one shard's documents with their bins. Whole sequences of long documents fill bins of their own first."""
    pdf = pdf.sort_values(["size_", "id_", "source_", "cluster_"], ascending=[False, True, True, True], na_position="last")
    pieces, rests, n_bins = [], [], 0
    for row in pdf.itertuples(index=False):
        full, rest = divmod(row.size_, capacity)
        for k in range(full):
            pieces.append((row.id_, k, k * capacity, capacity, n_bins, 0))
            n_bins += 1
        if rest:
            rests.append((rest, row.source_, row.cluster_, row.id_, full))
        elif not full:
            pieces.append((row.id_, 0, 0, 0, None, 0))
    rests.sort(key=lambda r: -r[0])
    used: dict[int, int] = {}
    for (rest, _, _, doc, full), b in zip(rests, best_fit([r[:3] for r in rests], capacity)):
        pieces.append((doc, full, full * capacity, rest, n_bins + b, used.get(b, 0)))
        used[b] = used.get(b, 0) + rest
    out = pd.DataFrame(pieces, columns=["id_", "piece", "first_word", "n_words", "bin_", "bin_offset"])
    shard = int(pdf["shard_"].iloc[0])
    out["bin_"] = out["bin_"].map(lambda b: None if pd.isna(b) else shard << 32 | int(b)).astype("Int64")
    out["id_"] = out["id_"].astype("Int64")
    return out


@F.arrow_udf(LongType())
def words(text: pa.Array) -> pa.Array:
    return count_words(text)


def near_clusters(docs: DataFrame, text: str = "text") -> DataFrame:
    """body_, near_: for the hash of each text the component of near copies it is in, whatever the ids of its rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    links = link_documents(docs.select(F.xxhash64(body).alias("doc_id"), body.alias("text")))
    return saved(links.groupBy(F.col("doc_id").alias("body_")).agg(F.min("component_id").alias("near_")))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cluster: Column | None = None,
         size: Column | None = None, near: DataFrame | None = None, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each piece: doc_id, piece, first_word, n_words, bin_id, bin_offset (words before it in its bin).

    A document of `capacity` words or more fills whole bins and its rest is packed. Rests go, largest first, into the
    tightest open bin of its shard that has the room and holds no document of the same source and none of the same cluster
    (given as a column of docs, or by `near`, the near_clusters() of docs; unset, equal texts but for case). Documents are dealt by id, text and source to shards of about `shard_rows`,
    which pack on their own; rows equal in all three are numbered and dealt on by their number, so no task holds many more, whatever the
    ids and sources. The deal and the order within a shard depend on rows only, not on partitions. Only ids, sizes and hashes are
    shuffled.

    Documents without words, and null texts, have one row with n_words 0 and a null bin. A null source is a source of its
    own. Repeated rows are packed each, in different bins. An empty table gives an empty result. Other columns do not
    matter, whatever their names.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    rows, names = sealed(docs)
    body = F.col(names[text])
    full = F.coalesce(body, F.lit(""))
    same = F.xxhash64(full if near is not None else F.lower(full))
    narrow = rows.select(
        F.col(names[doc_id]).cast("long").alias("id_"), (words(body) if size is None else size).alias("size_"),
        F.xxhash64(F.col(names[source]).isNull(), names[source]).alias("source_"), (same if cluster is None else F.xxhash64(cluster)).alias("cluster_"), same.alias("body_"))
    if near is not None:
        narrow = attach(saved(narrow), near, ["body_"], ["id_", "source_"]).withColumn("cluster_", F.col("near_")).drop("near_")
    key = ["id_", "body_", "source_", "size_", "cluster_"]
    copies = narrow.groupBy(*key).agg(F.count("*").alias("n_")).select(*key, F.explode(F.sequence(F.lit(1), "n_")).alias("copy_"))
    narrow = copies.select("id_", "size_", "source_", "cluster_", F.pmod(
        F.xxhash64("id_", "body_", "source_", "copy_", F.lit("shard")), F.lit(shards)).alias("shard_"))
    packed = narrow.groupBy("shard_").applyInPandas(
        lambda pdf: pack_shard(pdf, capacity),
        "id_ long, piece int, first_word long, n_words long, bin_ long, bin_offset long")
    return packed.select(F.col("id_").alias("doc_id"), "piece", "first_word", "n_words", F.col("bin_").alias("bin_id"), "bin_offset")
