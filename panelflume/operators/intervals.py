"""Joins of points with the intervals they lie in, at any grain of time.

An interval is cut at buckets of a size that fits its length, so it has at most PIECES + 1 rows whether it lasts a minute or a
century; a point looks into one bucket of every size in use. Both sides meet by equality of bucket and size, and the exact bounds
are the residual. Buckets with many rows on one side are joins that adaptive execution can split.

Flags and sums of smooth effects make no pairs: within a bucket, points and the ends of intervals are sorted by time, and a running
maximum or sum says what holds at each point. Their work grows with the rows, however many intervals overlap.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

PIECES = 8
BASE_SECONDS = 60
GRID = 12


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _size(level: Column) -> Column:
    return (F.pow(F.lit(float(PIECES)), level) * BASE_SECONDS * 1_000_000).cast("long")


def _levels(cut: DataFrame) -> list[int]:
    return sorted(r[0] for r in cut.select("level_").distinct().collect())


def _looked(points: DataFrame, levels: list[int]) -> DataFrame:
    """A row of points for every level."""
    return points.withColumn("level_", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))


def _met(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Points and pieces of intervals, with the level_ and bucket_ where they meet."""
    length = _micros(F.col(end)) - _micros(F.col(start))
    level = F.greatest(F.ceil(F.log(float(PIECES), length / (PIECES * BASE_SECONDS * 1e6))), F.lit(0)).cast("int")
    cut = intervals.filter(F.col(start) < F.col(end)).withColumn("level_", level)
    first, last = F.floor(_micros(F.col(start)) / _size(F.col("level_"))), F.floor((_micros(F.col(end)) - 1) / _size(F.col("level_")))
    pieces = cut.withColumn("bucket_", F.explode(F.sequence(first, last)))
    return _looked(points, _levels(cut)).withColumn("bucket_", F.floor(_micros(F.col(at)) / _size(F.col("level_")))), pieces


def matched(points: DataFrame, intervals: DataFrame, at: str, start: str = "start", end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """Columns of points and intervals for every pair with start <= at < end and equal keys. Empty and reversed intervals match nothing.

    Columns other than the keys must differ in name. The sizes in use are listed first: some twenty at most.
    """
    looked, pieces = _met(points, intervals, at, start, end, keys)
    met = looked.join(pieces, [*keys, "level_", "bucket_"])
    return met.filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("level_", "bucket_")


def flagged(points: DataFrame, intervals: DataFrame, key: str, at: str, name: str, start: str = "start", end: str = "end",
            keys: tuple[str, ...] = ()) -> DataFrame:
    """points with name = 1 where a row lies in any interval. key names a row.

    In each bucket, in order of time, the latest end of the pieces begun so far tells whether one still lasts.
    """
    narrow = points.select(key, at, *keys).dropna(subset=[at, *keys])
    looked, pieces = _met(narrow, intervals, at, start, end, keys)
    group, begin, size = [*keys, "level_", "bucket_"], F.col("bucket_") * _size(F.col("level_")), _size(F.col("level_"))
    ends = pieces.groupBy(*group, F.greatest(_micros(F.col(start)), begin).alias("from_")).agg(F.max(F.least(_micros(F.col(end)), begin + size)).alias("to_"))
    when = looked.select(*group, _micros(F.col(at)).alias("at_"), F.col(key).alias("key_"))
    rows = ends.withColumn("order_", F.col("from_") * 2).drop("from_").unionByName(when.withColumn("order_", F.col("at_") * 2 + 1), allowMissingColumns=True)
    so_far = Window.partitionBy(*group).orderBy("order_").rowsBetween(Window.unboundedPreceding, 0)
    hit = rows.withColumn("to_", F.max("to_").over(so_far)).filter("to_ > at_").select(F.col("key_").alias(key)).distinct().withColumn(name, F.lit(1))
    return points.join(hit, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def summed(points: DataFrame, intervals: DataFrame, key: str, at: str, effect: Column | Callable[[Column], Column], name: str,
           nodes: int | None = None, start: str = "start", end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """points with the sum of an effect over all intervals a row lies in, 0 where it lies in none.

    The effect is a column of point and interval columns, or a function of the time that gives such a column. With `nodes` it must be such
    a function of time and interval columns, smooth over an interval and an eighth of its length to either side: see smooth_sums.
    Without, every pair of a point and an interval is made, and their number grows with the overlap.
    """
    narrow = points.select(key, at, *keys)
    if nodes:
        parts = smooth_sums(narrow, intervals, key, at, effect, nodes, start, end, keys)
    else:
        parts = matched(narrow, intervals, at, start, end, keys).select(key, (effect(F.col(at)) if callable(effect) else effect).alias("part_"))
    sums = parts.groupBy(key).agg(F.sum("part_").alias(name))
    return points.join(sums, key, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def smooth_sums(points: DataFrame, intervals: DataFrame, key: str, at: str, effect: Callable[[Column], Column], nodes: int, start: str = "start",
                end: str = "end", keys: tuple[str, ...] = ()) -> DataFrame:
    """key, part_: parts of the sums of a smooth effect, without pairs; those of a row add up to its sum.

    An interval is cut at buckets of 2^k microseconds, at most 16 and more than 8 to its length. The effect of each piece is a polynomial
    through its values at `nodes` Chebyshev points of the bucket, and the polynomials of many intervals add up by those values. Whole
    pieces are added per bucket. Where intervals begin or end within it, the values run up in order of time: those begun by then, and,
    backward, those that have not ended. Nothing is ever subtracted, so large values and NaN leave no trace where their interval does
    not reach. With n nodes the error is about 2 (h / 4)^n / n! times the effect's n-th derivative, for buckets of length h. Intervals
    shorter than 16 * 2^GRID microseconds (66 ms) are paired with their points.
    """
    places = [round(2 ** (GRID - 1) * (1 - math.cos(math.pi * (2 * j + 1) / (2 * nodes)))) for j in range(nodes)]
    weights = [1 / math.prod((p - q) / 2 ** (GRID - 2) for q in places if q != p) for p in places]
    lo, hi = _micros(F.col(start)), _micros(F.col(end))
    cut = intervals.filter(F.col(start) < F.col(end)).dropna(subset=list(keys)).withColumn("level_", (F.ceil(F.log2((hi - lo).cast("double"))) - 4).cast("int"))
    levels = _levels(cut)
    long, size, group = cut.filter(F.col("level_") >= GRID), F.expr("shiftleft(1L, level_)"), [*keys, "level_", "bucket_"]

    def finite(e):
        return F.abs(e) < float("inf")

    def value(place):
        return effect(F.timestamp_micros(F.col("bucket_") + place * F.expr(f"shiftleft(1L, level_ - {GRID})")))

    whole = long.withColumn("bucket_", F.explode(F.sequence(lo + F.pmod(-lo, size), hi - F.pmod(hi, size) - size, size)))
    whole = whole.select("*", F.posexplode(F.array(*map(F.lit, places))).alias("node_", "place_")).withColumn("e_", value(F.col("place_")))
    whole = whole.groupBy(*group, "node_").agg(F.sum(F.when(finite(F.col("e_")), F.col("e_"))).alias("e_"), F.sum(F.when(~finite(F.col("e_")), F.col("e_"))).alias("odd_"))
    rows = whole.select(*group, F.lit(0).alias("side_"), F.lit(-2 ** 62).alias("order_"), "odd_",
                        F.array(*[F.when(F.col("node_") == j, F.col("e_")) for j in range(nodes)]).alias("values_"))
    for side, time in ((0, lo), (1, hi)):
        within = F.pmod(time, size)
        edge = long.filter(within > 0).withColumn("bucket_", time - within)
        here = effect(F.timestamp_micros(time))
        values = F.transform(F.array(*map(F.lit, places)), value)
        rows = rows.unionByName(edge.select(*group, F.lit(side).alias("side_"), (time * (2 - 4 * side)).alias("order_"), F.when(~finite(here), here).alias("odd_"),
                                            F.when(finite(here), values).alias("values_")))

    when = _micros(F.col(at))
    looked = _looked(points.dropna(subset=[at, *keys]), [v for v in levels if v >= GRID]).withColumn("bucket_", when - F.pmod(when, size))
    x = F.pmod(when, size) / F.expr(f"shiftleft(1L, level_ - {GRID})")
    looked = looked.select(*group, F.col(key).alias("key_"), when.alias("at_"), x.alias("x_"), F.explode(F.array(F.lit(0), F.lit(1))).alias("side_"))
    looked = looked.withColumn("order_", (F.col("at_") * 2 + 1) * (1 - 2 * F.col("side_"))).drop("at_")
    so_far = Window.partitionBy(*group, "side_").orderBy("order_").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.unionByName(looked, allowMissingColumns=True)
    run = run.select("key_", "x_", F.sum("odd_").over(so_far).alias("odd_"), *[F.sum(F.col("values_")[j]).over(so_far).alias(f"v{j}_") for j in range(nodes)])
    found = run.filter("x_ is not null")
    shares = [F.try_divide(F.lit(w), F.col("x_") - F.lit(float(p))) for p, w in zip(places, weights)]
    between = sum(s * F.coalesce(f"v{j}_", F.lit(0.0)) for j, s in enumerate(shares)) / sum(shares)
    on_node = F.coalesce(*[F.when(F.col("x_") == float(p), F.col(f"v{j}_")) for j, p in enumerate(places)])
    parts = found.select(F.col("key_").alias(key), (F.coalesce(between, on_node, F.lit(0.0)) + F.coalesce("odd_", F.lit(0.0))).alias("part_"))
    if levels and levels[0] < GRID:
        pairs = matched(points, cut.filter(F.col("level_") < GRID).drop("level_"), at, start, end, keys)
        parts = parts.unionByName(pairs.select(key, effect(F.col(at)).alias("part_")))
    return parts


def interpolated(points: DataFrame, regimes: DataFrame, key: str, at: str, name: str, outside: float = 1.0, start: str = "start",
                 end: str = "end") -> DataFrame:
    """points with the value at `at` on the line from v0 at the start to v1 at the end of its regime; regimes don't overlap."""
    share = (_micros(F.col(at)) - _micros(F.col(start))) / (_micros(F.col(end)) - _micros(F.col(start)))
    value = F.col("v0") + (F.col("v1") - F.col("v0")) * share
    found = matched(points.select(key, at), regimes, at, start, end).select(key, value.alias(name))
    return points.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit(outside)))
