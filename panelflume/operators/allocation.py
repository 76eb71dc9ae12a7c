"""Constrained cabin allocation over a table of flights.

Per flight, seats x over four cabins maximise sum(yield * fill * x) subject to a seat total, a load-factor floor and a
box per cabin (the class floors are box bounds). The two coupling rows leave a short parametric search that is exact
and runs on whole Arrow batches. There is no shuffle, and columns the programme does not need never reach Python.
"""
from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import half_even, half_up_integer, or_default
from panelflume.functions.shapes import record

TOL = 1e-9
PARAMS = ["forecast_pax", "capacity", "lf_target", "ob_rate", "min_eco_pct", "min_first_pct"]
YIELDS = [f"y_{c}" for c in fv.CABINS]


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill absent, NULL and zero parameters with the defaults."""
    defaults = {**fv.ALLOCATION_DEFAULTS, **{f"y_{c}": v for c, v in fv.CABIN_YIELDS.items()}}
    return df.withColumns({name: (or_default(F.col(name).cast("double"), value) if name in df.columns
                                  else F.lit(float(value))) for name, value in defaults.items()})


def fill_columns() -> dict[str, Column]:
    """Probability that a seat of each cabin sells, given the demand signal; never above the cabin's fill rate."""
    signal = F.least(F.lit(fv.FILL_SIGNAL_CAP),
                     F.col("forecast_pax") / F.greatest(F.col("capacity") * F.col("lf_target"), F.lit(1.0)))
    return {f"dp_{c}": F.least(F.lit(rate) * signal, F.lit(rate)) for c, rate in zip(fv.CABINS, fv.FILL_RATES)}


def greedy(key, low, span, room):
    """Seats when room is handed out in descending key order, each cabin up to its span above its lower bound."""
    order = np.argsort(-key, axis=1, kind="stable")
    ranked = np.take_along_axis(span, order, axis=1)
    before = np.cumsum(ranked, axis=1) - ranked
    given = np.clip(room[:, None] - before, 0.0, ranked)
    seats = np.empty_like(given)
    np.put_along_axis(seats, order, given, axis=1)
    return low + seats


def solve(pax, cap, lf, ob, eco, first, ylds):
    """Vectorised over flights. Returns seats (n, 4), revenue, capacity price and feasibility.

    With a price on load, the best use of the seat total is greedy in yield plus priced load, and the greedy order
    only changes where two cabins tie, at up to six prices. The load carried rises with the price, so the optimum is
    the free solution if that carries enough load, and else the blend of the two greedy solutions on either side of
    the price at which the floor is reached. The capacity price is the value of the last seat handed out.
    """
    fill = np.array(fv.FILL_RATES)
    signal = np.minimum(fv.FILL_SIGNAL_CAP, pax / np.maximum(cap * lf, 1.0))
    d = np.minimum(fill * signal[:, None], fill)
    v = ylds * d
    low = np.zeros_like(v)
    low[:, 0], low[:, 3] = first * cap, eco * cap
    span = np.array(fv.MAX_MIX) * cap[:, None] - low
    slack = TOL * cap
    boxes = (span >= -slack[:, None]).all(axis=1)
    span = np.maximum(span, 0.0)
    spare = cap * (1 + ob) - low.sum(axis=1)
    room = np.clip(spare, 0.0, span.sum(axis=1))
    floor = lf * cap

    with np.errstate(all="ignore"):
        ties = [(v[:, j] - v[:, i]) / (d[:, i] - d[:, j]) for i, j in itertools.combinations(range(4), 2)]
        prices = np.column_stack([np.zeros(len(pax)), *ties])
    prices = np.sort(np.where(np.isfinite(prices) & (prices > 0), prices, 0.0), axis=1)
    upper = np.column_stack([prices[:, 1:], 2 * prices[:, -1:] + 1.0])

    seats = greedy(v + (prices[:, :1] + upper[:, :1]) / 2 * d, low, span, room)
    load = (d * seats).sum(axis=1)
    price = np.zeros(len(pax))
    open_rows = load < floor + slack
    for k in range(1, prices.shape[1]):
        if not open_rows.any():
            break
        after = greedy(v + ((prices[:, k] + upper[:, k]) / 2)[:, None] * d, low, span, room)
        load_after = (d * after).sum(axis=1)
        gain = load_after - load
        rises = open_rows & (gain > slack)
        share = np.clip(np.where(rises, (floor - load) / np.where(gain > 0, gain, 1.0), 0.0), 0.0, 1.0)
        seats = np.where(rises[:, None], seats + share[:, None] * (after - seats), seats)
        price = np.where(rises, prices[:, k], price)
        load = np.where(rises, load + share * gain, load)
        open_rows = open_rows & (load_after < floor + slack)

    key = v + price[:, None] * d
    used = seats > low + slack[:, None]
    last = np.where(used, key, np.inf).min(axis=1)
    shadow = np.where(np.isfinite(last) & (spare <= span.sum(axis=1) + slack), last, 0.0)
    feasible = boxes & (spare >= -slack) & (load >= floor - slack)
    return seats, (v * seats).sum(axis=1), shadow, feasible


@F.pandas_udf(record(**{c: "double" for c in fv.CABINS}, revenue="double", shadow="double", feasible="bool"))
def _solve_batch(pax: pd.Series, cap: pd.Series, lf: pd.Series, ob: pd.Series, eco: pd.Series, first: pd.Series,
                 y0: pd.Series, y1: pd.Series, y2: pd.Series, y3: pd.Series) -> pd.DataFrame:
    columns = [s.to_numpy(float) for s in (pax, cap, lf, ob, eco, first)]
    ylds = np.column_stack([s.to_numpy(float) for s in (y0, y1, y2, y3)])
    seats, revenue, shadow, feasible = solve(*columns, ylds)
    return pd.DataFrame({**{c: seats[:, i] for i, c in enumerate(fv.CABINS)}, "revenue": revenue,
                         "shadow": shadow, "feasible": feasible})


def optimise(df: DataFrame, rounded: bool = True) -> DataFrame:
    """Add the allocation record to every flight row. df needs forecast_pax; other parameters default.

    Where no allocation is feasible the default mix is used and lp_success is false.
    """
    flights = with_defaults(df.withColumn("forecast_pax", F.col("forecast_pax").cast("double")))
    flights = flights.withColumns(fill_columns()).withColumn("_lp", _solve_batch(*PARAMS, *YIELDS))
    ok, cap = F.col("_lp.feasible"), F.col("capacity")

    def cabin_sum(term):
        return sum((term(c, m) for c, m in list(zip(fv.CABINS, fv.DEFAULT_MIX))[1:]),
                   term(fv.CABINS[0], fv.DEFAULT_MIX[0]))

    mix_revenue = cabin_sum(lambda c, m: F.lit(m) * cap * F.col(f"y_{c}") * F.col(f"dp_{c}"))
    flat = cabin_sum(lambda c, m: F.lit(m) * cap * F.col(f"y_{c}") * F.col("lf_target"))
    out = flights.withColumns({f"x_{c}": F.when(ok, F.col(f"_lp.{c}")).otherwise(F.lit(m) * cap)
                               for c, m in zip(fv.CABINS, fv.DEFAULT_MIX)})
    out = out.withColumns({
        "lp_success": ok,
        "revenue": F.when(ok, F.col("_lp.revenue")).otherwise(mix_revenue),
        "flat_revenue": flat,
        "bid_eco": F.when(ok, F.col("_lp.shadow")).otherwise(F.col("y_eco") * F.col("dp_eco")),
    })
    ratio = F.when(F.col("y_eco") > 0, F.col("bid_eco") * F.col("y_biz") / F.col("y_eco")).otherwise(
        F.col("y_biz") * F.col("dp_biz"))
    out = out.withColumns({
        "bid_biz": F.when(ok, ratio).otherwise(F.col("y_biz") * F.col("dp_biz")),
        "uplift": (F.col("revenue") - F.col("flat_revenue")) / F.greatest(F.col("flat_revenue"), F.lit(1.0)) * 100.0,
    }).drop("_lp")
    return allocation_record(out, df.columns) if rounded else out


def allocation_record(solved: DataFrame, keep: list[str]) -> DataFrame:
    """Rounded allocation record. Values are settled at six decimals first, so that float noise does not decide ties."""
    def tidy(c: Column, digits: int) -> Column:
        return half_even(half_even(c, 6), digits)

    kept = [c for c in keep if c not in ("lp_success",)]
    return solved.select(
        *kept,
        *[tidy(F.col(f"x_{c}"), 0).cast("long").alias(f"{c}_seats") for c in fv.CABINS],
        *[tidy(F.col(f"x_{c}") / F.col("capacity") * 100.0, 1).alias(f"{c}_pct") for c in fv.CABINS],
        tidy(F.col("revenue"), 0).alias("expected_revenue"),
        tidy(F.col("flat_revenue"), 0).alias("flat_baseline_rev"),
        tidy(F.col("uplift"), 2).alias("revenue_uplift_pct"),
        tidy(F.col("bid_eco"), 2).alias("bid_price_eco"),
        tidy(F.col("bid_biz"), 2).alias("bid_price_biz"),
        "lp_success",
    )


def sweep_grid(df: DataFrame, high: float = fv.SWEEP_HIGH, grid: list[int] | None = None) -> DataFrame:
    """One row per flight and economy floor: adds eco_fixed and min_eco_pct = eco_fixed / capacity.

    The default grid runs from 40 % of capacity up to, not including, `high`, in steps of five seats; a flight's grid
    is generated on its own row. A missing or zero capacity is the default one; a flight too small for any step has no rows.
    """
    default = F.lit(fv.ALLOCATION_DEFAULTS["capacity"])
    cap = F.coalesce(F.nullif("capacity", F.lit(0)), default) if "capacity" in df.columns else default
    if grid is None:
        low, top = (cap * fv.SWEEP_LOW).cast("int"), (cap * high).cast("int") - 1
        points = F.when(low <= top, F.sequence(low, F.greatest(low, top), F.lit(fv.SWEEP_STEP))).otherwise(F.array().cast("array<int>"))
    else:
        points = F.array(*[F.lit(g) for g in grid])
    rest = df.drop("min_eco_pct")
    return rest.withColumn("eco_fixed", F.explode(points)).withColumn(
        "min_eco_pct", F.col("eco_fixed").cast("double") / cap)


def sensitivity(df: DataFrame, keys: list[str], high: float = fv.SWEEP_HIGH, grid: list[int] | None = None) -> DataFrame:
    """Revenue, uplift and bid price over the economy-floor grid."""
    solved = optimise(sweep_grid(df, high, grid))
    return solved.select(
        *keys, F.col("eco_fixed").alias("eco_seats"), half_even(F.col("min_eco_pct") * 100.0, 1).alias("eco_pct"),
        "expected_revenue", F.col("revenue_uplift_pct").alias("revenue_uplift"), "bid_price_eco")


def what_if(df: DataFrame) -> DataFrame:
    """Proportional allocation: seats by value weight, floors for first and economy, excess taken from biz and prem."""
    flights = with_defaults(df)
    cap = F.col("capacity")
    signal = F.col("forecast_pax") / cap
    fill = {c: F.least(F.lit(fv.WHATIF_FILL_CAP), signal * (m / (m + fv.WHATIF_SOFTENING)))
            for c, m in zip(fv.CABINS, fv.DEFAULT_MIX)}
    out = flights.withColumns({f"w_{c}": F.col(f"y_{c}") * fill[c] for c in fv.CABINS})
    weight_sum = F.col("w_first") + F.col("w_biz") + F.col("w_prem") + F.col("w_eco")
    total = cap * (F.lit(1.0) + F.col("ob_rate"))
    out = out.withColumns({f"a_{c}": F.col(f"w_{c}") / weight_sum * total for c in fv.CABINS})
    out = out.withColumns({"a_first": F.greatest("a_first", F.lit(0.05) * cap),
                           "a_eco": F.greatest("a_eco", F.lit(0.45) * cap)})
    excess = F.greatest(F.col("a_first") + F.col("a_biz") + F.col("a_prem") + F.col("a_eco") - total, F.lit(0.0))
    out = out.withColumn("_excess", excess)
    biz_share, prem_share = fv.WHATIF_EXCESS_SPLIT
    out = out.withColumns({"a_biz": F.greatest(F.col("a_biz") - F.col("_excess") * biz_share, F.lit(0.0)),
                           "a_prem": F.greatest(F.col("a_prem") - F.col("_excess") * prem_share, F.lit(0.0))})
    revenue = sum((F.col(f"a_{c}") * F.col(f"w_{c}") for c in fv.CABINS[1:]), F.col("a_first") * F.col("w_first"))
    flat = cap * F.col("lf_target") * sum((F.col(f"y_{c}") * m for c, m in list(zip(fv.CABINS, fv.DEFAULT_MIX))[1:]),
                                          F.col("y_first") * fv.DEFAULT_MIX[0])
    out = out.withColumns({"whatif_revenue": revenue, "whatif_flat": flat})
    return out.select(
        *df.columns,
        *[half_up_integer(F.col(f"a_{c}")).alias(f"{c}_seats") for c in fv.CABINS],
        *[half_up_integer(F.col(f"a_{c}") / cap * 100.0).alias(f"{c}_pct") for c in fv.CABINS],
        half_up_integer(F.col("whatif_revenue")).alias("revenue"),
        ((F.col("whatif_revenue") - F.col("whatif_flat")) / F.col("whatif_flat") * 100.0).alias("uplift_pct"),
        half_up_integer(F.col("w_eco")).alias("bid_price"))


def what_if_curve(df: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue of a fixed split of the non-economy seats over a grid of economy seats, against the flat baseline."""
    flights = with_defaults(df)
    start, step, points = fv.WHATIF_GRID
    cap = F.col("capacity")
    grid = F.array(*[F.lit(start + i * step) for i in range(points)])
    out = flights.withColumn("_share", F.explode(grid)).withColumn("eco_seats", half_up_integer(cap * F.col("_share")))
    rest = cap - F.col("eco_seats")
    first, biz = (half_up_integer(rest * s) for s in fv.WHATIF_REST_SPLIT)
    seats = {"first": first, "biz": biz, "prem": rest - first - biz, "eco": F.col("eco_seats")}
    fill = {c: F.least(F.lit(fv.WHATIF_FILL_CAP), F.col("lf_target") * (m / (m + fv.WHATIF_SOFTENING)))
            for c, m in zip(fv.CABINS, fv.DEFAULT_MIX)}
    revenue = sum((seats[c] * fill[c] * F.col(f"y_{c}") for c in fv.CABINS[1:]),
                  seats["first"] * fill["first"] * F.col("y_first"))
    flat = cap * F.col("lf_target") * sum((F.col(f"y_{c}") * m for c, m in list(zip(fv.CABINS, fv.DEFAULT_MIX))[1:]),
                                          F.col("y_first") * fv.DEFAULT_MIX[0])
    return out.select(*keys, "eco_seats", half_up_integer(revenue).alias("revenue"),
                      half_up_integer(flat).alias("flat_revenue"))


def flight_demand(forecasts: DataFrame, flights: DataFrame) -> DataFrame:
    """Mean test forecast per route as demand per flight: share of the weekly total over seven times daily flights."""
    weekly = forecasts.filter(F.col("period") == "test").groupBy("route").agg(F.avg("hybrid_fc").alias("weekly_pax"))
    per_week = F.coalesce(F.col("flights"), F.lit(fv.DEFAULT_DAILY_FLIGHTS)) * 7
    return (weekly.join(flights, "route", "left")
            .withColumn("flights_per_week", per_week)
            .withColumn("forecast_pax", F.col("weekly_pax") * fv.MARKET_SHARE / F.col("flights_per_week"))
            .drop("flights"))


def scaled_yields(routes: DataFrame, panel: DataFrame, base_yield: float = fv.BASE_YIELD) -> DataFrame:
    """Cabin yields in whole units, scaled by the route's mean yield over the base yield."""
    means = panel.groupBy("route").agg(F.avg("yield_aud").alias("avg_yield"))
    scalar = F.coalesce(F.col("avg_yield"), F.lit(base_yield)) / F.lit(base_yield)
    joined = routes.join(means, "route", "left").withColumn("yield_scalar", scalar)
    return joined.withColumns({f"y_{c}": half_even(F.lit(v) * F.col("yield_scalar"), 0)
                               for c, v in fv.CABIN_YIELDS.items()}).drop("avg_yield")
