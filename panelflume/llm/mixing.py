"""Mixing sources to target weights: weighted sampling keys, prefix sums to word budgets, complete epochs first."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume.llm.common import opened, saved, sealed, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 1024


def quality_weight(text: Column, size: Column) -> Column:
    """1 for texts of usual word lengths (3 to 12 characters with the gap), else a quarter."""
    return F.when(F.length(text).between(size * 3, size * 12), F.lit(1.0)).otherwise(F.lit(0.25))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes (none_, source_, size_: a row per source) with target_.

    Sources by code point, null last, carry the repeating weights and share `share` times the whole size. A target stops
    at `most` times its source; what that frees goes to the others by weight. Sorted by the level at which each source
    fills up, the sources that fill up come first, so one running sum finds the common level of the rest.
    The windows see one row per source.
    """
    by_name, everything = Window.orderBy("none_", "source_"), Window.partitionBy()
    rank = (F.row_number().over(by_name) - 1).cast("int")
    table = sizes.withColumn("w_", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank % len(weights) + 1))
    table = table.withColumns({"cap_": F.col("size_") * most, "whole_": F.sum("size_").over(everything) * share})
    table = table.withColumn("fills_", F.col("cap_") / F.col("w_"))
    order = Window.orderBy("fills_", "none_", "source_")
    table = table.withColumns({
        "before_": F.coalesce(F.sum("cap_").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest_": F.sum("w_").over(order.rowsBetween(0, Window.unboundedFollowing))})
    table = table.withColumn("level_", (F.col("whole_") - F.col("before_")) / F.col("rest_"))
    full = F.col("level_") > F.col("fills_")
    level = F.min(F.when(~full, F.struct("fills_", "none_", "source_", "level_"))).over(everything)["level_"]
    return table.select("none_", "source_", "size_",
                        F.when(full, F.col("cap_").cast("double")).otherwise(F.col("w_") * level).alias("target_"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", order: str = "doc_id", weight: Column | None = None,
        weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS, seed: str = "mix", buckets: int = BUCKETS) -> DataFrame:
    """Every row of docs with size, source_size, target, epochs, taken and sampling_key.

    A source's rows are sorted by the key -ln(u) / weight, u being drawn from a hash of seed and id. Each whole multiple of
    the source that fits in the target is one epoch for all its rows; the remaining words go to the leading rows, up to
    the row whose middle passes the remainder. Prefix sums take two levels: keys fall into `buckets` ranges per source,
    ranges are summed first, and only rows of one range are sorted together, so a source of any size is spread.

    A null text has no words, and rows without words are taken zero times. A null source is a source of its own. Ties in
    key go by id, then size. Two runs over the same rows agree. An empty table gives an empty result. A column of docs
    named like a result column is replaced by it.
    """
    results = ["size", "source_size", "target", "epochs", "taken", "sampling_key"]
    docs = docs.drop(*results)
    rows, names = sealed(docs)
    body, key = F.col(names[text]), F.col(names[order])
    rows = rows.withColumns({"none_": F.col(names[source]).isNull(), "source_": F.coalesce(names[source], F.lit("")),
                             "n_": words(body)})
    draw = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10)
            .cast("double") + 0.5) / float(1 << 52)
    rows = rows.withColumn("key_", -F.log(draw) / (quality_weight(body, F.col("n_")) if weight is None else weight))
    rows = rows.withColumn("range_", F.floor((1 - F.exp(-F.col("key_") / 2)) * buckets).cast("int"))
    ranges = saved(rows.groupBy("none_", "source_", "range_").agg(F.sum("n_").alias("range_size_")))
    targets = source_targets(ranges.groupBy("none_", "source_").agg(F.sum("range_size_").alias("size_")), weights, share, most)
    so_far = Window.partitionBy("none_", "source_").orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ranges.withColumn("offset_", F.coalesce(F.sum("range_size_").over(so_far), F.lit(0)))
              .join(saved(targets), ["none_", "source_"]).drop("range_size_"))
    rows = rows.join(ranges, ["none_", "source_", "range_"])
    inside = (Window.partitionBy("none_", "source_", "range_").orderBy("key_", names[order], "n_")
              .rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("offset_") + F.sum("n_").over(inside) - F.col("n_")
    rows = rows.withColumn("before_", before)
    rows = rows.withColumn("epochs_", F.when(F.col("size_") > 0, F.floor(F.col("target_") / F.col("size_"))).otherwise(0))
    left = F.col("target_") - F.col("epochs_") * F.col("size_")
    extra = (F.col("n_") > 0) & (F.col("before_") * 2 + F.col("n_") <= left * 2)
    times = F.when(F.col("n_") > 0, F.col("epochs_") + extra.cast("long")).otherwise(0)
    rows = rows.withColumn("times_", times.cast("long"))
    return opened(rows, names, F.col("n_").alias("size"), F.col("size_").alias("source_size"), F.col("target_").alias("target"),
                  F.col("times_").alias("epochs"), (F.col("times_") * F.col("n_")).alias("taken"),
                  F.col("key_").alias("sampling_key"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with the columns of docs, each as often as it is taken."""
    safe, names = sealed(docs, "d")
    options = {k: names.get(options.get(k, v), options.get(k, v)) for k, v in
               {"source": "source", "text": "text", "order": "doc_id"}.items()} | {
        k: v for k, v in options.items() if k not in ("source", "text", "order")}
    taken = mix(safe, **options).where("epochs > 0")
    return opened(taken.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int")))), names)
