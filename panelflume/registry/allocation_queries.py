"""Queries on cabin allocation."""
from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from panelflume import fixed_values as fv
from panelflume.operators import allocation, filters
from panelflume.plans import stages
from panelflume.registry.base import LOOKUPS, PANEL, demo, panel, query, rounded
from panelflume.registry.forecast_queries import CHAIN, chain_table
from panelflume.sources import table
from panelflume.sources.files import cut_lineage

CABINS = fv.CABINS


def flights(spark, sf):
    """One flight per order; capacity, demand and yields vary with the order."""
    o = table(spark, sf, "orders")
    capacity = F.get(F.array(F.lit(174.0), F.lit(189.0), F.lit(215.0)), (F.col("o_custkey") % 3).cast("int"))
    scalar = F.lit(0.6) + F.floor("o_totalprice") % 80 / F.lit(100.0)
    return o.select("o_orderkey", capacity.alias("capacity"),
                    (F.lit(140.0) + F.lit(2.0) * (F.col("o_orderkey") % 30)).alias("forecast_pax"),
                    *[F.bround(F.lit(v) * scalar, 0).alias(f"y_{c}") for c, v in fv.CABIN_YIELDS.items()])


FLIGHTS = "flights AS (SELECT o_orderkey, [174.0::DOUBLE, 189, 215][1 + o_custkey % 3] AS capacity, " \
    "140.0::DOUBLE + 2 * (o_orderkey % 30) AS forecast_pax, " + ", ".join(
        f"round_even({v}::DOUBLE * (0.6::DOUBLE + CAST(floor(o_totalprice) AS BIGINT) % 80 / 100.0::DOUBLE), 0) AS y_{c}"
        for c, v in fv.CABIN_YIELDS.items()) + \
    ", 0.85::DOUBLE AS lf_target, 0.05::DOUBLE AS ob_rate, 0.45::DOUBLE AS min_eco_pct, 0.05::DOUBLE AS min_first_pct FROM orders)"
DP = ", ".join(f"least({r}::DOUBLE * least(1.25, forecast_pax / greatest(capacity * lf_target, 1)), {r}) AS dp_{c}"
               for c, r in zip(CABINS, fv.FILL_RATES))


def candidates_sql() -> str:
    rows = []
    for sides in itertools.product((0, 1, 2), repeat=4):
        free = sides.count(2)
        if free <= 2:
            rows += [(*sides, kind) for kind in ((1, 2) if free == 1 else (0,))]
    return "(VALUES " + ", ".join(f"({', '.join(map(str, (i, *r)))})" for i, r in enumerate(rows)) + \
        ") AS c(id, s0, s1, s2, s3, kind)"


def lp_sql(source: str, keys: str) -> str:
    """CTE `best`: optimum per flight at the seat total and slightly below it, by trying every basis.

    The capacity price is the revenue lost per seat when the total shrinks by a thousandth of a seat.
    """
    low = ["min_first_pct * capacity", "0.0::DOUBLE", "0.0::DOUBLE", "min_eco_pct * capacity"]
    high = [f"{m}::DOUBLE * capacity" for m in fv.MAX_MIX]
    fixed = [f"CASE s{i} WHEN 0 THEN {low[i]} WHEN 1 THEN {high[i]} ELSE 0 END AS f{i}" for i in range(4)]
    df = " + ".join(f"CASE WHEN s{i} = 2 THEN dp_{c} ELSE 0 END" for i, c in enumerate(CABINS))
    nfree = " + ".join(f"CAST(s{i} = 2 AS INTEGER)" for i in range(4))
    seats = "total - f0 - f1 - f2 - f3"
    load = "load - " + " - ".join(f"dp_{c} * f{i}" for i, c in enumerate(CABINS))
    xs = [f"""CASE WHEN s{i} <> 2 THEN f{i} WHEN nfree = 1 AND kind = 1 THEN seats WHEN nfree = 1 THEN need / dp_{c}
        ELSE (need - (dfree - dp_{c}) * seats) / (2 * dp_{c} - dfree) END AS x{i}""" for i, c in enumerate(CABINS)]
    tol = "1e-9 * capacity"
    ok = " AND ".join(f"x{i} BETWEEN {low[i]} - {tol} AND {high[i]} + {tol}" for i in range(4))
    dsum = " + ".join(f"dp_{c} * x{i}" for i, c in enumerate(CABINS))
    rev = " + ".join(f"y_{c} * dp_{c} * x{i}" for i, c in enumerate(CABINS))
    return f"""dps AS (SELECT *, {DP} FROM {source}),
  tries AS (SELECT d.*, c.*, h.h, capacity * (1 + ob_rate) - h.h AS total, lf_target * capacity AS load,
    {', '.join(fixed)}, {nfree} AS nfree, {df} AS dfree FROM dps d, {candidates_sql()}, (VALUES (0.0::DOUBLE), (1e-3)) AS h(h)),
  needs AS (SELECT *, {seats} AS seats, {load} AS need FROM tries),
  points AS (SELECT *, {', '.join(xs)} FROM needs),
  feasible AS (SELECT *, {rev} AS rev FROM points WHERE {ok} AND x0 + x1 + x2 + x3 <= total + {tol} AND {dsum} >= load - {tol}),
  best AS (SELECT {keys}, max(rev) FILTER (h = 0) AS rev, max(rev) FILTER (h > 0) AS rev_less,
    {', '.join(f'arg_max(x{i}, rev) FILTER (h = 0) AS x{i}' for i in range(4))} FROM feasible GROUP BY {keys}),
  solved AS (SELECT d.*, b.rev IS NOT NULL AS lp_success,
    {', '.join(f'CASE WHEN b.rev IS NULL THEN {m}::DOUBLE * capacity ELSE greatest(b.x{i}, 0) END AS x{i}' for i, m in enumerate(fv.DEFAULT_MIX))},
    CASE WHEN b.rev IS NULL THEN {' + '.join(f'{m}::DOUBLE * capacity * y_{c} * dp_{c}' for c, m in zip(CABINS, fv.DEFAULT_MIX))} ELSE b.rev END AS revenue,
    {' + '.join(f'{m}::DOUBLE * capacity * y_{c} * lf_target' for c, m in zip(CABINS, fv.DEFAULT_MIX))} AS flat,
    CASE WHEN b.rev IS NULL THEN y_eco * dp_eco ELSE (b.rev - b.rev_less) / 1e-3 END AS bid_eco
    FROM dps d LEFT JOIN best b USING ({keys}))"""


SEATS_SQL = ", ".join(f"CAST(round_even(round(x{i}, 6), 0) AS BIGINT) AS {c}_seats" for i, c in enumerate(CABINS))
PCT_SQL = ", ".join(f"round_even(round_even(x{i} / capacity * 100, 6), 1) AS {c}_pct" for i, c in enumerate(CABINS))
LP = f"WITH {FLIGHTS}, {lp_sql('flights', 'o_orderkey')} "


@query("k01_fill_probabilities", f"WITH {FLIGHTS} SELECT o_orderkey, {', '.join(f'round(dp_{c}, 8) AS dp_{c}' for c in CABINS)} "
       f"FROM (SELECT *, {DP} FROM flights)")
def _fill(spark, sf):
    df = allocation.with_defaults(flights(spark, sf)).withColumns(allocation.fill_columns())
    cols = [f"dp_{c}" for c in CABINS]
    return rounded(df.select("o_orderkey", *cols), {c: 8 for c in cols})


@query("k02_lp_allocation", LP + """SELECT o_orderkey, round(x0, 4) AS x_first, round(x1, 4) AS x_biz, round(x2, 4) AS x_prem,
    round(x3, 4) AS x_eco, round(revenue, 4) AS revenue, lp_success FROM solved""")
def _lp(spark, sf):
    df = allocation.optimise(flights(spark, sf), rounded=False)
    cols = [f"x_{c}" for c in CABINS]
    return rounded(df.select("o_orderkey", *cols, "revenue", "lp_success"), {**{c: 4 for c in cols}, "revenue": 4})


@query("k03_infeasible_fallback", LP + "SELECT o_orderkey, round(revenue, 4) AS revenue FROM solved WHERE NOT lp_success")
def _fallback(spark, sf):
    df = allocation.optimise(flights(spark, sf), rounded=False)
    return rounded(df.filter(~F.col("lp_success")).select("o_orderkey", "revenue"), {"revenue": 4})


@query("k04_capacity_price", LP + """SELECT o_orderkey, round(bid_eco, 3) AS bid_eco,
    round(CASE WHEN lp_success THEN bid_eco * y_biz / y_eco ELSE y_biz * dp_biz END, 2) AS bid_biz FROM solved""")
def _price(spark, sf):
    df = allocation.optimise(flights(spark, sf), rounded=False)
    return rounded(df.select("o_orderkey", "bid_eco", "bid_biz"), {"bid_eco": 3, "bid_biz": 2})


@query("k05_flat_baseline", LP + """SELECT o_orderkey, round(flat, 4) AS flat_revenue,
    round((revenue - flat) / greatest(flat, 1) * 100, 6) AS uplift FROM solved""")
def _flat(spark, sf):
    df = allocation.optimise(flights(spark, sf), rounded=False)
    return rounded(df.select("o_orderkey", "flat_revenue", "uplift"), {"flat_revenue": 4, "uplift": 6})


@query("k06_allocation_record", LP + f"""SELECT o_orderkey, {SEATS_SQL}, {PCT_SQL}, round_even(round_even(revenue, 6), 0) AS expected_revenue,
    round_even(round_even(flat, 6), 0) AS flat_baseline_rev, round_even(round_even((revenue - flat) / greatest(flat, 1) * 100, 6), 2) AS revenue_uplift_pct,
    lp_success FROM solved""")
def allocation_record(spark, sf):
    return allocation.optimise(flights(spark, sf)).select(
        "o_orderkey", *[f"{c}_seats" for c in CABINS], *[f"{c}_pct" for c in CABINS], "expected_revenue",
        "flat_baseline_rev", "revenue_uplift_pct", "lp_success")


# Route level -------------------------------------------------------------------------------------------------------

CAPACITY = 20
NAIVE_BODY = f"""naive AS (SELECT route, date, pax, lag(pax, 52) OVER (PARTITION BY route ORDER BY date) AS fc,
    row_number() OVER (PARTITION BY route ORDER BY date) > count(*) OVER (PARTITION BY route) - 26 AS test FROM panel),
  demand AS (SELECT n.route, avg(fc) AS weekly_pax, coalesce(any_value(f.flights), 5) * 7 AS flights_per_week
    FROM naive n LEFT JOIN daily_flights f ON n.route = f.route WHERE test GROUP BY n.route),
  per_flight AS (SELECT *, weekly_pax * 0.58::DOUBLE / flights_per_week AS forecast_pax FROM demand),
  means AS (SELECT route, avg(yield_aud) / 900 AS yield_scalar FROM panel GROUP BY route),
  scaled AS (SELECT p.*, yield_scalar, {CAPACITY}.0::DOUBLE AS capacity, 0.85::DOUBLE AS lf_target, 0.05::DOUBLE AS ob_rate,
    0.45::DOUBLE AS min_eco_pct, 0.05::DOUBLE AS min_first_pct,
    {', '.join(f'round_even({v}::DOUBLE * yield_scalar, 0) AS y_{c}' for c, v in fv.CABIN_YIELDS.items())}
    FROM per_flight p JOIN means m ON p.route = m.route)"""
NAIVE = f"{PANEL}, {LOOKUPS}, {NAIVE_BODY}"
# The same from the forecasts of the serving chain.
CHAIN_BODY = """demand AS (SELECT t.route, avg(hybrid_fc) AS weekly_pax, coalesce(any_value(f.flights), 5) * 7 AS flights_per_week
    FROM ft t LEFT JOIN daily_flights f ON t.route = f.route WHERE period = 'test' GROUP BY t.route),
  """ + NAIVE_BODY[NAIVE_BODY.index("per_flight AS"):]
BASE = 900.0


def naive_forecasts(p):
    """Seasonal-naive forecasts in forecast-table form: lag 52 as the forecast of the last 26 rows."""
    split = filters.holdout_split(p, fv.TEST_WEEKS)
    return split.withColumn("hybrid_fc", F.lag("pax", 52).over(filters.series_window()))


def _demand(spark, sf):
    return allocation.flight_demand(naive_forecasts(panel(spark, sf)), demo(spark, "daily_flights"))


@query("d10_demand_per_flight", f"WITH {NAIVE} SELECT route, round(weekly_pax, 6) AS weekly_pax, flights_per_week, "
       "round(forecast_pax, 6) AS forecast_pax FROM per_flight")
def _per_flight(spark, sf):
    return rounded(_demand(spark, sf), {"weekly_pax": 6, "forecast_pax": 6})


@query("c07_yield_scaling", f"WITH {NAIVE} SELECT route, round(yield_scalar, 6) AS yield_scalar, "
       f"{', '.join(f'y_{c}' for c in CABINS)} FROM scaled")
def _scaling(spark, sf):
    p = panel(spark, sf)
    out = allocation.scaled_yields(demo(spark, "routes").select("route"), p, BASE)
    return rounded(out, {"yield_scalar": 6})


@query("c08_mapped_lookup", f"WITH {PANEL}, {LOOKUPS} SELECT DISTINCT p.route, coalesce(f.flights, 5) * 7 AS flights_per_week "
       "FROM panel p LEFT JOIN daily_flights f ON p.route = f.route")
def _mapped(spark, sf):
    joined = panel(spark, sf).select("route").distinct().join(demo(spark, "daily_flights"), "route", "left")
    return joined.select("route", (F.coalesce("flights", F.lit(fv.DEFAULT_DAILY_FLIGHTS)) * 7).alias("flights_per_week"))


@query("c10_parameter_grid", "SELECT n_name, CAST(g.e AS INTEGER) AS eco_fixed, round(g.e / 189.0::DOUBLE, 8) AS min_eco_pct "
       "FROM nation, generate_series(75, 150, 5) g(e)")
def _grid(spark, sf):
    df = table(spark, sf, "nation").select("n_name", F.lit(189.0).alias("capacity"))
    return rounded(allocation.sweep_grid(df).select("n_name", "eco_fixed", "min_eco_pct"), {"min_eco_pct": 8})


@query("k07_sensitivity_sweep", f"""WITH {FLIGHTS}, by_mode AS (SELECT o_orderpriority, max(capacity) AS capacity,
      avg(forecast_pax) AS forecast_pax, 4200.0::DOUBLE AS y_first, 1850.0::DOUBLE AS y_biz, 680.0::DOUBLE AS y_prem,
      310.0::DOUBLE AS y_eco, 0.85::DOUBLE AS lf_target, 0.05::DOUBLE AS ob_rate, 0.05::DOUBLE AS min_first_pct
      FROM flights JOIN orders USING (o_orderkey) GROUP BY 1),
    swept AS (SELECT m.*, e AS eco_fixed, e / capacity AS min_eco_pct FROM by_mode m,
      generate_series(CAST(floor(capacity * 0.4::DOUBLE) AS INTEGER), CAST(floor(capacity * 0.8::DOUBLE) AS INTEGER) - 1, 5) g(e)),
    {lp_sql('swept', 'o_orderpriority, eco_fixed')}
    SELECT o_orderpriority, CAST(eco_fixed AS INTEGER) AS eco_seats, round_even(min_eco_pct * 100, 1) AS eco_pct,
      round_even(round_even(revenue, 6), 0) AS expected_revenue, round_even(round_even((revenue - flat) / greatest(flat, 1) * 100, 6), 2) AS revenue_uplift,
      round_even(round_even(bid_eco, 5), 2) AS bid_price_eco FROM solved""")
def _sweep(spark, sf):
    means = flights(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey").groupBy(
        "o_orderpriority").agg(F.max("capacity").alias("capacity"), F.avg("forecast_pax").alias("forecast_pax"))
    return allocation.sensitivity(means, ["o_orderpriority"])


@query("k08_route_allocation", f"""WITH RECURSIVE {CHAIN}, {LOOKUPS}, {CHAIN_BODY}, {lp_sql('scaled', 'route')}
    SELECT route, CAST(round_even(forecast_pax, 0) AS BIGINT) AS forecast_pax, {SEATS_SQL}, {PCT_SQL},
    round_even(round_even(revenue, 6), 0) AS expected_revenue, round_even(round_even(flat, 6), 0) AS flat_baseline_rev,
    round_even(round_even((revenue - flat) / greatest(flat, 1) * 100, 6), 2) AS revenue_uplift_pct, round_even(round_even(bid_eco, 5), 2) AS bid_price_eco,
    lp_success FROM solved""")
def route_allocation(spark, sf):
    p = cut_lineage(panel(spark, sf))
    return stages.allocate(chain_table(p), p, demo(spark, "daily_flights"), BASE,
                           {"capacity": float(CAPACITY)})["lp_results"]


MIX = dict(zip(CABINS, fv.DEFAULT_MIX))
WEIGHT = {c: f"y_{c} * least(0.95, forecast_pax / capacity * ({m}::DOUBLE / ({m}::DOUBLE + 0.01::DOUBLE)))" for c, m in MIX.items()}
JS = "CAST(floor({} + 0.5) AS BIGINT) AS {}"


@query("k09_what_if", f"""WITH {FLIGHTS}, w AS (SELECT *, {', '.join(f'{v} AS w_{c}' for c, v in WEIGHT.items())},
      capacity * (1 + ob_rate) AS total FROM flights),
    a AS (SELECT *, {', '.join(f'w_{c} / (w_first + w_biz + w_prem + w_eco) * total AS r_{c}' for c in CABINS)} FROM w),
    b AS (SELECT *, greatest(r_first, 0.05::DOUBLE * capacity) AS a_first, greatest(r_eco, 0.45::DOUBLE * capacity) AS a_eco FROM a),
    e AS (SELECT *, greatest(a_first + r_biz + r_prem + a_eco - total, 0) AS excess FROM b),
    x AS (SELECT *, greatest(r_biz - excess * 0.6::DOUBLE, 0) AS a_biz, greatest(r_prem - excess * 0.4::DOUBLE, 0) AS a_prem FROM e),
    z AS (SELECT *, {' + '.join(f'a_{c} * w_{c}' for c in CABINS)} AS rev,
      capacity * lf_target * ({' + '.join(f'y_{c} * {m}::DOUBLE' for c, m in MIX.items())}) AS flat FROM x)
    SELECT o_orderkey, {', '.join(JS.format(f'a_{c}', f'{c}_seats') for c in CABINS)},
      {JS.format('rev', 'revenue')}, round((rev - flat) / flat * 100, 6) AS uplift_pct, {JS.format('w_eco', 'bid_price')} FROM z""")
def _what_if(spark, sf):
    out = allocation.what_if(flights(spark, sf))
    return rounded(out.select("o_orderkey", *[f"{c}_seats" for c in CABINS], "revenue", "uplift_pct", "bid_price"),
                   {"uplift_pct": 6})


@query("k10_what_if_curve", f"""WITH {FLIGHTS}, g AS (SELECT f.*, CAST(floor(capacity * (0.4::DOUBLE + i * 0.02::DOUBLE) + 0.5) AS BIGINT) AS eco
      FROM flights f, generate_series(0, 14) t(i)),
    s AS (SELECT *, CAST(floor((capacity - eco) * 0.12::DOUBLE + 0.5) AS BIGINT) AS n_first,
      CAST(floor((capacity - eco) * 0.36::DOUBLE + 0.5) AS BIGINT) AS n_biz FROM g),
    v AS (SELECT *, capacity - eco - n_first - n_biz AS n_prem, eco AS n_eco FROM s)
    SELECT o_orderkey, eco AS eco_seats, CAST(floor({' + '.join(
        f'n_{c} * least(0.95, lf_target * ({m}::DOUBLE / ({m}::DOUBLE + 0.01::DOUBLE))) * y_{c}' for c, m in MIX.items())} + 0.5) AS BIGINT) AS revenue,
      CAST(floor(capacity * lf_target * ({' + '.join(f'y_{c} * {m}::DOUBLE' for c, m in MIX.items())}) + 0.5) AS BIGINT) AS flat_revenue FROM v""")
def _curve(spark, sf):
    return allocation.what_if_curve(flights(spark, sf), ["o_orderkey"])
