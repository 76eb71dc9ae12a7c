"""Queries on the serving tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelflume.operators import did, enrich, metrics
from panelflume.plans import serving, stages
from panelflume.registry.allocation_queries import BASE, CAPACITY, CHAIN_BODY, lp_sql
from panelflume.registry.base import (BASE_YEAR, EXPERIMENTS, LOOKUPS, PANEL, did_fit_sql, did_rows_sql, demo, demo_tables, panel,
                                      query, rounded)
from panelflume import fixed_values as fv
from panelflume.sources.files import cut_lineage, shared_folder, write_results
from panelflume.registry.causal_queries import _FULL, DID, START, _fitted, _specs, _table_sql
from panelflume.registry.forecast_queries import CHAIN, METRICS_SQL, chain_table


@query("l01_coefficient_rows", DID + """SELECT outcome, position, coefficient, round(estimate, 4) AS estimate, round(se, 4) AS se, round(t, 4) AS t FROM (
    SELECT outcome, 0 AS position, 'intercept' AS coefficient, mean_0_0 AS estimate, NULL::DOUBLE AS se, NULL::DOUBLE AS t FROM f
    UNION ALL SELECT outcome, 1, 'treated', mean_1_0 - mean_0_0, NULL, NULL FROM f
    UNION ALL SELECT outcome, 2, 'post', mean_0_1 - mean_0_0, NULL, NULL FROM f
    UNION ALL SELECT outcome, 3, 'att', att, att_se, att / att_se FROM f)""")
def _coefficients(spark, sf):
    rows = did.coefficient_rows(_fitted(spark, sf))
    return rounded(rows.drop("experiment"), {"estimate": 4, "se": 4, "t": 4})


ALLOCATED = f"""{CHAIN_BODY}, {lp_sql('scaled', 'route')}, lp AS (SELECT route,
    round_even(round_even((revenue - flat) / greatest(flat, 1) * 100, 6), 2) AS revenue_uplift_pct FROM solved)"""
FORECASTS = CHAIN[len(PANEL) + 2:]
RESULTS = f"""{_FULL}, {FORECASTS}, {ALLOCATED}, m AS ({METRICS_SQL}), el AS ({_table_sql('only_here AS (SELECT 1)')})"""


def _inputs(spark, sf):
    p = cut_lineage(panel(spark, sf))
    t = cut_lineage(chain_table(p))
    lp = stages.allocate(t, p, demo(spark, "daily_flights"), BASE, {"capacity": float(CAPACITY)})["lp_results"]
    recent = enrich.calendar(p.filter(F.col("date") >= F.lit(START).cast("date")), demo_tables(spark), BASE_YEAR)
    return p, metrics.forecast_metrics(t), stages.elasticity_table(recent, START), lp


@query("c09_results_wide_join", f"""WITH RECURSIVE {CHAIN}, {LOOKUPS}, {ALLOCATED}, m AS ({METRICS_SQL})
    SELECT m.route, n_test, round(hybrid_rmse, 4) AS hybrid_rmse, revenue_uplift_pct, route_desc
    FROM m LEFT JOIN lp USING (route) LEFT JOIN routes USING (route)""")
def _wide(spark, sf):
    p = cut_lineage(panel(spark, sf))
    t = cut_lineage(chain_table(p))
    lp = stages.allocate(t, p, demo(spark, "daily_flights"), BASE, {"capacity": float(CAPACITY)})["lp_results"]
    m = metrics.forecast_metrics(t).select("route", "n_test", "hybrid_rmse")
    wide = m.join(lp.select("route", "revenue_uplift_pct"), "route", "left").join(
        demo(spark, "routes").select("route", "route_desc"), "route", "left")
    return rounded(wide, {"hybrid_rmse": 4})


@query("l02_scorecard", f"""WITH RECURSIVE {RESULTS} SELECT m.route, round(hw_mape, 8) AS hw_mape, round(hybrid_mape, 8) AS hybrid_mape,
    round((hw_mape - hybrid_mape) / hw_mape * 100, 6) AS mape_improvement_pct, round(hybrid_r2, 8) AS hybrid_r2, revenue_uplift_pct,
    preferred_elasticity FROM m LEFT JOIN lp USING (route) LEFT JOIN el USING (route)""")
def scorecard(spark, sf):
    _, m, el, lp = _inputs(spark, sf)
    return rounded(serving.scorecard(m, el, lp), {"hw_mape": 8, "hybrid_mape": 8, "mape_improvement_pct": 6, "hybrid_r2": 8})


@query("l03_headline", f"""WITH RECURSIVE {RESULTS}, {did_rows_sql(EXPERIMENTS[:1])}, {did_fit_sql('d', 'po', 'f')}
    SELECT kpi, round(value, 4) AS value FROM (
    SELECT 'mean_hybrid_mape' AS kpi, avg(hybrid_mape) AS value FROM m UNION ALL SELECT 'mean_hw_mape', avg(hw_mape) FROM m
    UNION ALL SELECT 'mean_uplift_pct', avg(revenue_uplift_pct) FROM lp
    UNION ALL SELECT 'elasticity', max(preferred_elasticity) FROM el WHERE route = 'ASIA'
    UNION ALL SELECT 'att', max(att) FROM f WHERE outcome = 'yield_aud' UNION ALL SELECT 'n_obs', max(n_obs) FROM f WHERE outcome = 'yield_aud')""")
def _headline(spark, sf):
    p, m, el, lp = _inputs(spark, sf)
    effects = did.estimate(p, _specs(spark), ["yield_aud"], p_values=False)
    return rounded(serving.headline(m, el, effects, lp, "ASIA"), {"value": 4})


NINE = f"""WITH {PANEL}, n AS (SELECT route, count(*) AS n, count(*) FILTER (date >= DATE '{START}' AND pax > 0) AS late FROM panel GROUP BY route),
    f AS (SELECT * FROM n WHERE n > 78)
    SELECT 'model_metrics' AS name, count(*) AS n_rows FROM f UNION ALL SELECT 'forecasts', CAST(sum(26 + least(52, n - 78)) AS BIGINT) FROM f
    UNION ALL SELECT 'feature_importance', 30 * count(*) FROM f UNION ALL SELECT 'cv_results', 3 * count(*) FROM f
    UNION ALL SELECT 'decompositions', count(*) FROM f UNION ALL SELECT 'did_results', 2
    UNION ALL SELECT 'elasticity', count(*) FROM n WHERE late >= {fv.ELASTICITY_MIN_OBS}
    UNION ALL SELECT 'lp_results', count(*) FROM f UNION ALL SELECT 'lp_sensitivity', 14 * count(*) FROM f"""


@query("a08_nine_tables", NINE)
def _nine(spark, sf):
    p = cut_lineage(enrich.calendar(panel(spark, sf), demo_tables(spark), BASE_YEAR))
    tables = stages.forecast(p, base_year=BASE_YEAR)
    tables |= stages.causal(p, _specs(spark), elasticity_start=START)
    tables |= stages.allocate(tables["forecasts"], p, demo(spark, "daily_flights"), BASE)
    folder = shared_folder(spark)
    write_results(tables, folder)
    counts = [spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows") for name in tables]
    return reduce(DataFrame.unionByName, counts)
