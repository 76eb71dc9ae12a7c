"""Shared pieces of the registered queries: look-up tables dated like the test data, and the checking SQL of the panel.

The checking SQL is written on its own terms: correlated subqueries and plain joins where the Spark side uses
pre-aggregation, day expansion and array folds.
"""
from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume.operators import enrich, features
from panelflume.sources.lookups import SHAPES, values_sql, values_table
from panelflume.sources.star import panel


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, sf_dir) under name, with its checking SQL."""
    def wrap(fn):
        QUERIES[name] = Query(fn, sql)
        return fn
    return wrap


YEARS = range(1994, 2002)
BASE_YEAR = 1995
ROWS = {
    "school_holidays": [iv for y in YEARS for iv in (
        (f"{y}-12-18", f"{y + 1}-01-28"), (f"{y}-04-05", f"{y}-04-20"), (f"{y}-07-05", f"{y}-07-21"),
        (f"{y}-09-20", f"{y}-10-05"))],
    "public_holidays": [(f"{y}-{md}",) for y in YEARS for md in ("01-01", "01-26", "04-25", "06-10", "12-25", "12-26")],
    "events": [ev for y in YEARS for ev in (
        (f"EXPO_{y}", f"{y}-03-15", "AS", 1.18, 4), (f"FAIR_{y}", f"{y}-06-20", "E", 1.12, 2),
        (f"CUP_{y}", f"{y}-06-30", "EUR", 1.2, 3), (f"GAMES_{y}", f"{y}-09-28", "A", 1.1, 1))],
    "regimes": [("1997-07-07", "1997-10-06", 1.0, 0.6), ("1997-10-06", "1998-03-02", 0.6, 0.6),
                ("1998-03-02", "1998-10-05", 0.6, 0.85), ("1998-10-05", "1999-04-05", 0.85, 1.0)],
    "macro": [(1995, 0.055, 0.028, 100.0), (1996, 0.0525, 0.03, 108.0), (1997, 0.0575, 0.023, 103.0),
              (1998, 0.0525, 0.016, 78.0), (1999, 0.0475, 0.022, 118.0), (2000, 0.0625, 0.034, 142.0)],
    "competition_rules": [(1998, "RIVAL", None, 0.65), (1997, None, 0.6, 1.08), (1998, "NEWCO", None, 0.9)],
    "daily_flights": [("AFRICA", 2), ("AMERICA", 9), ("ASIA", 14), ("EUROPE", 6)],
    "routes": [
        ("AFRICA", "Africa lanes", 900, 700, 8200, ["RIVAL"], 0.31, 0.41, 0.81, 0.031),
        ("AMERICA", "America lanes", 950, 720, 6100, ["RIVAL", "NEWCO"], 0.42, 0.22, 0.84, 0.018),
        ("ASIA", "Asia lanes", 990, 690, 7400, ["NEWCO"], 0.38, 0.19, 0.83, 0.027),
        ("EUROPE", "Europe lanes", 940, 710, 2600, [], 0.28, 0.31, 0.79, 0.021),
        ("MIDDLE EAST", "Middle East lanes", 930, 705, 4900, ["RIVAL"], 0.35, 0.26, 0.82, 0.024),
    ],
}
EXPERIMENTS = [
    ("e1", "1998-07-06", ["ASIA", "EUROPE"], ["AMERICA", "AFRICA"], 52, 26),
    ("e2", "1997-03-03", ["AMERICA"], ["ASIA", "AFRICA", "MIDDLE EAST"], 40, 20),
    ("e3", "2000-01-03", ["MIDDLE EAST", "AFRICA"], ["EUROPE"], 30, 30),
]


def demo(spark: SparkSession, name: str) -> DataFrame:
    return values_table(spark, SHAPES[name], ROWS[name])


def demo_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: demo(spark, n) for n in ("school_holidays", "public_holidays", "events", "regimes", "macro")}


def demo_sql(name: str, alias: str = "t") -> str:
    text = values_sql(SHAPES[name], ROWS[name], alias, array_word="list_value")
    return text.replace("list_value()", "CAST([] AS VARCHAR[])")


def enriched(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return enrich.calendar(panel(spark, sf_dir, **kw), demo_tables(spark), BASE_YEAR)


def feature_frame(spark: SparkSession, sf_dir: str, grain: str = "region", **kw) -> DataFrame:
    return features.add_features(enriched(spark, sf_dir, grain=grain), base_year=BASE_YEAR, **kw)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round for comparison and turn the date into text."""
    out = df.withColumns({c: F.round(c, d) for c, d in digits.items()})
    return iso(out)


def iso(df: DataFrame, *names: str) -> DataFrame:
    dates = names or tuple(c for c, t in df.dtypes if t == "date")
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates}) if dates else df


PANEL_MEASURES = """
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pax,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2)))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2)))) AS DOUBLE)
    / sum(CAST(l_quantity AS BIGINT)) AS yield_aud,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) / 50.0::DOUBLE AS load_factor,
  CAST(sum(CAST(l_discount AS DECIMAL(5,2))) AS DOUBLE) / count(*) AS competition_index,
  100.0::DOUBLE * (1.0::DOUBLE + CAST(sum(CAST(l_tax AS DECIMAL(5,2))) AS DOUBLE) / count(*)) AS fuel_index,
  CAST(count(DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderkey END) AS DOUBLE)
    / count(DISTINCT o_orderkey) AS business_mix,
  CAST(any_value(week(o_orderdate)) AS INTEGER) AS week_of_year,
  CAST(any_value(year(date_trunc('week', o_orderdate))) AS INTEGER) AS year,
  CAST(any_value(month(date_trunc('week', o_orderdate))) AS INTEGER) AS month,
  CAST(any_value(quarter(date_trunc('week', o_orderdate))) AS INTEGER) AS quarter
"""
ORDER_JOINS = """
  lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def panel_sql(route: str = "r_name", extra_join: str = "") -> str:
    return f"""panel AS (
  SELECT {route} AS route, CAST(date_trunc('week', o_orderdate) AS DATE) AS date, {PANEL_MEASURES}
  FROM {ORDER_JOINS} {extra_join}
  GROUP BY 1, 2)"""


PANEL = panel_sql()
LOOKUPS = ", ".join(f"{name} AS (SELECT * FROM {demo_sql(name)})" for name in SHAPES)
EVENT_SUM = """(SELECT sum((peak_mult - 1) * exp(-0.5 * power(
      (date_diff('day', p.date, event_date) / 7.0::DOUBLE) / greatest(lead_weeks / 2.5::DOUBLE, 0.5), 2)))
    FROM events WHERE date_diff('day', p.date, event_date) BETWEEN -7 AND 7 * lead_weeks
      AND contains(p.route, city))"""
REGIME = """(SELECT v0 + (v1 - v0) * date_diff('day', from_date, p.date) / date_diff('day', from_date, to_date)
    FROM regimes WHERE p.date >= from_date AND p.date < to_date)"""
CPI = f"""coalesce((SELECT product(1 + coalesce(m.cpi, 0.025)) FROM generate_series({BASE_YEAR}, p.year) g(y)
    LEFT JOIN macro m ON m.year = g.y), 1)"""
ENRICHED = f"""{PANEL}, {LOOKUPS}, enriched AS (
  SELECT p.*,
    CAST(EXISTS (SELECT 1 FROM school_holidays WHERE p.date BETWEEN start_date AND end_date) AS INTEGER) AS school_holiday,
    CAST(EXISTS (SELECT 1 FROM public_holidays WHERE day BETWEEN p.date AND p.date + 6) AS INTEGER) AS public_holiday,
    round_even(1 + coalesce({EVENT_SUM}, 0), 4) AS event_multiplier,
    round_even(coalesce({REGIME}, 1), 4) AS covid_factor,
    coalesce(a.rate, 0.035) AS rba_cash_rate, coalesce(a.cpi, 0.025) AS inflation, coalesce(a.fuel, 100) AS macro_fuel,
    round_even({CPI}, 4) AS cpi_index
  FROM panel p LEFT JOIN macro a ON a.year = p.year)"""


def features_sql(leak_free: bool = False) -> str:
    """CTE chain ending in `feat`: every feature, first 52 rows of each route included."""
    last, current = (("1", "lag(pax, 1) OVER w") if leak_free else ("0", "pax"))
    span = (lambda k: f"ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING") if leak_free else (
        lambda k: f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW")
    return f"""{ENRICHED}, windowed AS (
  SELECT *, lag(pax, 4) OVER w AS pax_lag4, lag(pax, 8) OVER w AS pax_lag8, lag(pax, 13) OVER w AS pax_lag13,
    lag(pax, 52) OVER w AS pax_lag52, lag(yield_aud, 4) OVER w AS yield_lag4, {current} AS cur,
    avg(pax) OVER (PARTITION BY route ORDER BY date {span(4)}) AS rolling_mean_4w,
    coalesce(stddev_samp(pax) OVER (PARTITION BY route ORDER BY date {span(4)}), 0) AS rolling_std_4w,
    avg(pax) OVER (PARTITION BY route ORDER BY date {span(13)}) AS rolling_mean_13w
  FROM enriched WINDOW w AS (PARTITION BY route ORDER BY date)),
feat AS (
  SELECT *, sin(2 * pi() * week_of_year / 52) AS week_sin, cos(2 * pi() * week_of_year / 52) AS week_cos,
    sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos,
    CASE WHEN month IN (12, 1, 2) THEN 1 ELSE 0 END AS is_summer,
    CASE WHEN month BETWEEN 6 AND 8 THEN 1 ELSE 0 END AS is_winter,
    year - {BASE_YEAR} AS year_idx,
    CASE WHEN pax_lag52 IS NOT NULL THEN least(5, greatest(-1, cur / (pax_lag52 + 1.0::DOUBLE) - 1)) END AS pax_yoy_growth,
    cur / (rolling_mean_4w + 1) - 1 AS pax_vs_rolling,
    competition_index * business_mix AS comp_x_biz, rba_cash_rate * business_mix AS rate_x_biz,
    fuel_index / 100 * yield_aud AS fuel_x_yield, covid_factor * school_holiday AS covid_x_school
  FROM windowed)"""


FEATURES = features_sql()
DAY = "strftime(date, '%Y-%m-%d') AS date"


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


# Checking SQL for statistics ---------------------------------------------------------------------------------------

def sweep(prefix: str, source: str, keys: list[str], xs: list[str], y: str) -> str:
    """CTEs that regress y on xs per key by sweeping the covariance matrix, one regressor per CTE.

    The last CTE, <prefix>_fit, has the keys, n, means m0.., coefficients b0.., inverse diagonal i0.., and sse, sst.
    A regressor without remaining variance is passed over, with coefficient zero.
    """
    names = [*xs, y]
    p, key = len(names), ", ".join(keys)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    first = ", ".join([f"covar_pop({names[i]}, {names[j]}) AS a{i}_{j}" for i, j in pairs]
                      + [f"avg({v}) AS m{i}" for i, v in enumerate(names)])
    ctes = [f"{prefix}_0 AS (SELECT {key}, count(*) AS n, {first} FROM {source} GROUP BY {key})"]
    means = ", ".join(f"m{i}" for i in range(p))
    for k in range(p - 1):
        def at(i, j):
            return f"a{min(i, j)}_{max(i, j)}"
        cols, d = [], f"a{k}_{k}"
        for i, j in pairs:
            if i == k and j == k:
                new, flat = f"-1 / {d}", "0"
            elif k in (i, j):
                new, flat = f"{at(i, j)} / {d}", "0"
            else:
                new, flat = f"{at(i, j)} - {at(i, k)} * {at(k, j)} / {d}", at(i, j)
            cols.append(f"CASE WHEN {d} > 1e-14 THEN {new} ELSE {flat} END AS {at(i, j)}")
        orig = f"a{p - 1}_{p - 1} AS sst0" if k == 0 else "sst0"
        ctes.append(f"{prefix}_{k + 1} AS (SELECT {key}, n, {means}, {orig}, {', '.join(cols)} FROM {prefix}_{k})")
    last = ", ".join([f"a{i}_{p - 1} AS b{i}" for i in range(p - 1)] + [f"-a{i}_{i} AS i{i}" for i in range(p - 1)])
    ctes.append(f"{prefix}_fit AS (SELECT {key}, n, {means}, {last}, n * a{p - 1}_{p - 1} AS sse, n * sst0 AS sst "
                f"FROM {prefix}_{p - 1})")
    return ",\n".join(ctes)


def t_tail_sql(t: str, dof: str) -> str:
    """Two-sided Student-t p-value from the finite trigonometric series for whole degrees of freedom."""
    c2, theta = f"(({dof}) / (({dof}) + ({t}) * ({t})))", f"atan(abs({t}) / sqrt({dof}))"
    even = f"""sin({theta}) * (SELECT sum(exp(lgamma(j + 0.5) - lgamma(j + 1)) * power({c2}, j))
        FROM generate_series(0, CAST(({dof}) / 2 - 1 AS BIGINT)) g(j)) / sqrt(pi())"""
    odd = f"""2 / pi() * ({theta} + sin({theta}) * cos({theta}) * (SELECT sum(sqrt(pi()) / 2
        * exp(lgamma(j + 1) - lgamma(j + 1.5)) * power({c2}, j))
        FROM generate_series(0, CAST((({dof}) - 3) / 2 AS BIGINT)) g(j)))"""
    return f"(1 - CASE WHEN CAST({dof} AS BIGINT) % 2 = 0 THEN {even} ELSE {odd} END)"


def chi2_tail_sql(x: str) -> str:
    """Upper chi-square tail, one degree of freedom, from the all-positive series of the error function."""
    z = f"sqrt(({x}) / 2)"
    return f"""(CASE WHEN ({x}) > 60 THEN 0.0 ELSE 1 - 2 / sqrt(pi()) * exp(-({x}) / 2) * (SELECT sum(
        exp(j * ln(2.0) + (2 * j + 1) * ln(greatest({z}, 1e-300)) - (lgamma(2 * j + 2) - j * ln(2.0) - lgamma(j + 1))))
        FROM generate_series(0, 400) g(j)) END)"""


SPEC_COLUMNS = "experiment, treatment_date, treatment_routes, control_routes, pre_weeks, post_weeks"


def did_rows_sql(experiments: list[tuple]) -> str:
    """CTE `d`: panel rows per experiment, outcome in long form, as one join on list membership and date range."""
    from panelflume.operators.did import SPEC_SHAPE
    return f"""specs AS (SELECT * FROM {values_sql(SPEC_SHAPE, experiments, 't', 'list_value')}),
  d0 AS (SELECT s.experiment, s.pre_weeks, p.route, p.date, p.pax, p.yield_aud,
      CAST(list_contains(treatment_routes, p.route) AS INTEGER) AS tr, CAST(p.date >= treatment_date AS INTEGER) AS po
    FROM panel p JOIN specs s ON (list_contains(treatment_routes, p.route) OR list_contains(control_routes, p.route))
      AND p.date BETWEEN treatment_date - 7 * pre_weeks AND treatment_date + 7 * post_weeks),
  d AS (SELECT *, 'yield_aud' AS outcome, yield_aud AS y FROM d0 UNION ALL SELECT *, 'pax', CAST(pax AS DOUBLE) FROM d0)"""


def did_fit_sql(source: str, post: str, name: str) -> str:
    """CTE `name`: estimates per experiment and outcome from rows of `source`."""
    cells = [(tr, po) for tr in (0, 1) for po in (0, 1)]
    aggs = ", ".join(
        f"count(*) FILTER (tr = {a} AND {post} = {b}) AS n_{a}_{b}, "
        f"coalesce(avg(y) FILTER (tr = {a} AND {post} = {b}), 0) AS mean_{a}_{b}, "
        f"coalesce(var_pop(y) FILTER (tr = {a} AND {post} = {b}), 0) AS v_{a}_{b}" for a, b in cells)
    sse = " + ".join(f"n_{a}_{b} * v_{a}_{b}" for a, b in cells)
    inv = " + ".join(f"1.0::DOUBLE / n_{a}_{b}" for a, b in cells)
    hc = " + ".join(f"v_{a}_{b} / n_{a}_{b}" for a, b in cells)
    return f"""{name}_c AS (SELECT experiment, outcome, count(*) AS n_obs, {aggs} FROM {source} GROUP BY 1, 2),
  {name} AS (SELECT *, (mean_1_1 - mean_1_0) - (mean_0_1 - mean_0_0) AS att,
    sqrt(({sse}) / (n_obs - 4) * ({inv})) AS att_se, sqrt(n_obs / (n_obs - 4.0::DOUBLE) * ({hc})) AS att_se_hc1
    FROM {name}_c)"""
