"""Holt-Winters smoothing of series that are too long for one task, by a prefix over blocks of consecutive rows.

One step of the recursion maps the state (level, trend, one season of seasonal terms) to the next by an affine map that does not
depend on the values but in its constant. So does a block of steps: its linear part is the same for all blocks of one length, its
constant is what the block makes of a zero state. Blocks are run from zero side by side, the small constants are carried along
each series, and blocks are run again from the states they really begin with.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelflume.operators.blocks import with_positions
from panelflume.sources.files import cut_lineage


def run(y: np.ndarray, state: np.ndarray, first: int, params: tuple[float, float, float], season: int):
    """Steps from position `first` on: state is (season + 2, columns), its rows level, trend and the seasonal term of each phase.

    Yields level, trend, seasonal term and the term one season earlier, and leaves the last state in `state`.
    """
    alpha, beta, gamma = params
    for i, v in enumerate(y):
        t = first + i
        phase = 2 + t % season
        was = state[phase].copy() if t >= season else np.zeros(state.shape[1])
        level = alpha * (v - was) + (1 - alpha) * (state[0] + state[1])
        state[1] = beta * (level - state[0]) + (1 - beta) * state[1]
        state[0] = level
        state[phase] = gamma * (v - level) + (1 - gamma) * was
        yield level, state[1].copy(), state[phase].copy(), was


def linear_part(length: int, params: tuple[float, float, float], season: int) -> np.ndarray:
    """The matrix of a block of `length` steps, a multiple of the season, after the first season."""
    state = np.eye(season + 2)
    for _ in run(np.zeros(length), state, season, params, season):
        pass
    return state


def opening_state(opening: dict, season: int) -> np.ndarray:
    state = np.zeros((season + 2, 1))
    state[0], state[1], state[2] = opening["level"], opening["trend"], opening["first"]
    return state


def openings(placed: DataFrame, season: int) -> DataFrame:
    """route, level, trend, first (seasonal term) and n of each series, by one aggregate."""
    y, at = F.col("y"), F.col("position")
    one, two = F.avg(F.when(at < season, y)), F.avg(F.when((at >= season) & (at < 2 * season), y))
    begin, end, n = F.min(F.when(at == 0, y)), F.max_by(y, at), F.count(F.lit(1))
    sums = placed.groupBy("route").agg(one.alias("one"), two.alias("two"), begin.alias("begin"), end.alias("end"), n.alias("n"))
    long = F.col("n") >= 2 * season
    level = F.when(long, F.col("one")).otherwise(F.col("begin"))
    trend = F.when(long, (F.col("two") - F.col("one")) / season).otherwise((F.col("end") - F.col("begin")) / F.greatest(F.col("n") - 1, F.lit(1)))
    return sums.select("route", level.alias("level"), trend.alias("trend"), F.when(F.col("n") >= season, F.col("begin") - level).otherwise(0.0).alias("first"), "n")


def smooth(df: DataFrame, alpha: float, beta: float, gamma: float, season: int, bucket: Column, value: str = "pax",
           block_rows: int = 1 << 14) -> DataFrame:
    """Long components as of smoothing.fitted_rows(), with index, the period's own seasonal term, and position: route, date, position, y,
    level, trend, seasonal, index, fitted, residual.

    bucket does not decrease with time, e.g. the month: rows are numbered through counts per (route, bucket). block_rows is rounded
    up to whole seasons. No task holds more than a block; what is carried along a series is season + 2 numbers per block.
    """
    params = (alpha, beta, gamma)
    length = -(-block_rows // season) * season
    placed = cut_lineage(with_positions(df.select("route", "date", F.col(value).cast("double").alias("y")), bucket))
    begin = cut_lineage(openings(placed, season))
    block = F.floor(F.col("position") / length).alias("block")
    blocks = cut_lineage(placed.groupBy("route", block).agg(F.sort_array(F.collect_list(F.struct("position", "date", "y"))).alias("rows"))
                         .join(begin, "route"))
    last = F.floor((F.col("n") - 1) / length)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            routes, states = [], []
            for row in batch.to_pylist():
                state = opening_state(row, season) if row["block"] == 0 else np.zeros((season + 2, 1))
                skip = int(row["block"] == 0)
                for _ in run(np.array([r["y"] for r in row["rows"]])[skip:], state, row["block"] * length + skip, params, season):
                    pass
                states.append(state[:, 0].tolist())
                routes.append((row["route"], row["block"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in routes], pa.string()), pa.array([r[1] for r in routes], pa.int64()),
                                              pa.array(states, pa.list_(pa.float64()))], names=["route", "block", "state"])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, route, state = linear_part(length, params, season), None, None
        for batch in batches:
            out = []
            for r, b, made in zip(*(batch.column(i).to_pylist() for i in range(3))):
                made = np.array(made)
                state = made if b == 0 or r != route else matrix @ state + made
                route = r
                out.append((r, b + 1, state.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.list_(pa.float64()))], names=["route", "block", "state"])

    schema = "route string, block long, state array<double>"
    made = cut_lineage(blocks.filter(F.col("block") < last).mapInArrow(ends, schema))
    starts = made.repartition("route").sortWithinPartitions("route", "block").mapInArrow(carried, schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                y, at = np.array([r["y"] for r in row["rows"]]), row["block"] * length
                out = np.empty((len(y), 4))
                if row["block"] == 0:
                    state = opening_state(row, season)
                    out[0] = row["level"], row["trend"], row["first"], row["first"]
                    for i, part in enumerate(run(y[1:], state, 1, params, season), 1):
                        out[i] = [p[0] for p in part]
                else:
                    state = np.array(row["state"])[:, None]
                    for i, part in enumerate(run(y, state, at, params, season)):
                        out[i] = [p[0] for p in part]
                position = at + np.arange(len(y))
                fitted = out[:, 0] + out[:, 1] + out[:, 3]
                seasonal = np.where(position < season, row["first"], out[:, 3])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["route"]] * len(y), pa.string()), pa.array([r["date"] for r in row["rows"]], pa.date32()), pa.array(position, pa.int64()),
                    *[pa.array(c) for c in (y, out[:, 0], out[:, 1], seasonal, out[:, 2], fitted, y - fitted)]],
                    names=["route", "date", "position", "y", "level", "trend", "seasonal", "index", "fitted", "residual"])

    return blocks.join(starts, ["route", "block"], "left").mapInArrow(
        finished, "route string, date date, position long, y double, level double, trend double, seasonal double, index double, fitted double, residual double")


def forecast(components: DataFrame, steps: int, season: int) -> DataFrame:
    """route, step, hw_fc from smooth()'s rows, of which the last season is read. Series shorter than a season have no seasonal term."""
    ends = components.groupBy("route").agg(F.max("position").alias("last"), F.max_by(F.struct("level", "trend"), "position").alias("end"))
    ahead = ends.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn(
        "position", F.col("last") + 1 - season + (F.col("step") - 1) % season)
    index = components.select("route", "position", "index")
    return ahead.join(index, ["route", "position"], "left").select(
        "route", "step", (F.col("end.level") + F.col("step") * F.col("end.trend") + F.coalesce("index", F.lit(0.0))).alias("hw_fc"))
