"""The residual model by value, from Holt-Winters to the allocation: SQL smooths, grows the same trees again, and follows the chain.

The trees are stumps over features of few values (see forecast_queries), fitted by Spark ML as in the full model. The
stages, from the forecast table on, are those that the full model feeds.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from panelflume import fixed_values as fv
from panelflume.operators import hybrid, metrics, residual_model
from panelflume.plans import stages
from panelflume.registry.allocation_queries import BASE, CAPACITY, CHAIN_BODY, PCT_SQL, SEATS_SQL, lp_sql
from panelflume.registry.base import BASE_YEAR, DAY, FEATURES, PANEL, demo, enriched, feature_frame, panel, query, rounded
from panelflume.registry.forecast_queries import AS_NUMBERS, METRICS_SQL, STUMP_FEATURES, STUMPS, TRAINED, stumps_sql
from panelflume.sources.files import cut_lineage, export, read_export, shared_folder

STUMP_PARAMS = {"depth": 1, "subsample": 1.0, "stage_trees": 1}

# hw of TRAINED with the features; lvl is the mean of a route's training rows.
JOINED = f"""{FEATURES}, {TRAINED[len(PANEL) + 2:]}, joined AS MATERIALIZED (SELECT h.route, h.date, h.period, h.actual, h.hw_fc, {AS_NUMBERS},
      avg(h.actual) FILTER (h.period = 'train') OVER (PARTITION BY h.route) AS lvl FROM hw h JOIN feat f ON f.route = h.route AND f.date = h.date)"""
WHOLE = "SELECT 0 AS fold, *, CASE WHEN period = 'train' THEN actual - hw_fc END AS residual FROM joined"
CORRECTED = f"greatest(hw_fc + lvl * {residual_model.RATE} * fc, 0)"
MODEL = f"""{JOINED}, {stumps_sql(WHOLE)}, ft AS MATERIALIZED (SELECT route, date, period, actual, hw_fc, {CORRECTED} AS hybrid_fc FROM d{STUMPS})"""


def _frame(spark, sf):
    return cut_lineage(hybrid.smoothed_frame(feature_frame(spark, sf), names=STUMP_FEATURES))


def _forecasts(spark, sf):
    return hybrid.boost(_frame(spark, sf), STUMPS, STUMP_PARAMS)


@query("i04_hybrid_values", f"WITH RECURSIVE {MODEL} SELECT route, {DAY}, period, round(hw_fc, 4) AS hw_fc, round(hybrid_fc, 4) AS hybrid_fc FROM ft")
def _hybrid(spark, sf):
    out = _forecasts(spark, sf).select("route", "date", "period", "hw_fc", "hybrid_fc")
    return rounded(out, {"hw_fc": 4, "hybrid_fc": 4})


# A fold's rows: those before it with a residual, its own without.
FOLDED = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY route) AS m
      FROM joined WHERE period = 'train'),
    {stumps_sql('''SELECT f AS fold, * EXCLUDE (f), pos >= m - (4 - f) * 8 AS val, CASE WHEN pos < m - (4 - f) * 8 THEN actual - hw_fc END AS residual
      FROM numbered, generate_series(1, 3) g(f) WHERE pos < m - (4 - f) * 8 + 8''')},
    cv AS (SELECT route, fold, avg(abs((actual - hybrid_fc) / actual)) AS mape, sqrt(avg(power(actual - hybrid_fc, 2))) AS rmse
      FROM (SELECT *, """ + CORRECTED + f""" AS hybrid_fc FROM d{STUMPS}) WHERE val GROUP BY route, fold)"""


@query("i06_walk_forward_values", f"WITH RECURSIVE {JOINED}, {FOLDED} SELECT route, CAST(fold AS INTEGER) AS fold, round(mape, 8) AS mape, round(rmse, 4) AS rmse FROM cv")
def _folds(spark, sf):
    cv = hybrid.cross_validate(_frame(spark, sf), trees=STUMPS, params=STUMP_PARAMS)
    return rounded(cv.select("route", "fold", "mape", "rmse"), {"mape": 8, "rmse": 4})


@query("i07_model_metrics", f"""WITH RECURSIVE {MODEL}, m AS ({METRICS_SQL})
    SELECT route, n_train, n_test, round(hw_mape, 8) AS hw_mape, round(hybrid_mape, 8) AS hybrid_mape, round(hybrid_rmse, 4) AS hybrid_rmse,
      round(hybrid_r2, 8) AS hybrid_r2 FROM m""")
def _metrics(spark, sf):
    out = metrics.forecast_metrics(cut_lineage(_forecasts(spark, sf)))
    return rounded(out.select("route", "n_train", "n_test", "hw_mape", "hybrid_mape", "hybrid_rmse", "hybrid_r2"),
                   {"hw_mape": 8, "hybrid_mape": 8, "hybrid_rmse": 4, "hybrid_r2": 8})


@query("k08_model_allocation", f"""WITH RECURSIVE {MODEL}, {CHAIN_BODY}, {lp_sql('scaled', 'route')}
    SELECT route, CAST(round_even(forecast_pax, 0) AS BIGINT) AS forecast_pax, {SEATS_SQL}, {PCT_SQL},
    round_even(revenue, 0) AS expected_revenue, round_even(flat, 0) AS flat_baseline_rev, lp_success FROM solved""")
def _allocation(spark, sf):
    p = cut_lineage(panel(spark, sf))
    results = stages.allocate(_forecasts(spark, sf), p, demo(spark, "daily_flights"), BASE, {"capacity": float(CAPACITY)})["lp_results"]
    return results.drop("revenue_uplift_pct", "bid_price_eco")


def _importance_sql() -> str:
    """Every feature of the stumps shuffled within its route by the hash order of hybrid.permuted; the rise of the squared error row by row."""
    names = [*STUMP_FEATURES, "lvl"]

    def stump(k: int, swapped: str) -> str:
        side = " ".join(f"WHEN {i} THEN {'o' if c == swapped else 'a'}.{c}" for i, c in enumerate(names))
        return f"CASE WHEN CASE b{k}.f {side} END <= b{k}.threshold THEN b{k}.sl / b{k}.nl ELSE (b{k}.ss - b{k}.sl) / (b{k}.nn - b{k}.nl) END"

    trials = " UNION ALL ".join(
        f"""SELECT a.route, '{c}' AS feature_code, a.repeat, power(a.residual - a.lvl * {residual_model.RATE} * (0.0::DOUBLE + {' + '.join(stump(k, c) for k in range(STUMPS))}), 2)
          - power(a.residual - a.lvl * {residual_model.RATE} * a.fc, 2) AS rise
        FROM repeated a JOIN (SELECT *, row_number() OVER (PARTITION BY route, repeat ORDER BY md5(concat_ws('|', route, '{c}', repeat, i))) - 1 AS place
          FROM repeated) o ON o.route = a.route AND o.repeat = a.repeat AND o.place = a.i, {', '.join(f'b{k}' for k in range(STUMPS))}""" for c in STUMP_FEATURES)
    return f"""{MODEL}, repeated AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS i
        FROM d{STUMPS} WHERE period = 'train'), generate_series(1, {fv.IMPORTANCE_REPEATS}) g(repeat)),
      trial AS (SELECT route, feature_code, repeat, avg(rise) AS rise FROM ({trials}) GROUP BY 1, 2, 3),
      importance AS (SELECT route, feature_code, avg(rise) AS importance, stddev_pop(rise) AS importance_std,
        CAST(row_number() OVER (PARTITION BY route ORDER BY avg(rise) DESC, feature_code) AS INTEGER) AS rank FROM trial GROUP BY 1, 2)"""


@query("i09_importance_values", f"WITH RECURSIVE {_importance_sql()} SELECT route, feature_code, round(importance, 3) AS importance, "
       "round(importance_std, 3) AS importance_std, rank FROM importance")
def _importance(spark, sf):
    out = hybrid.importance(_frame(spark, sf), STUMP_FEATURES, STUMPS, params=STUMP_PARAMS)
    return rounded(out.select("route", "feature_code", "importance", "importance_std", "rank"), {"importance": 3, "importance_std": 3})


# What the forecast stage exports, read back from the committed version: rows and a sum of each table.
@query("a08_forecast_contents", f"""WITH RECURSIVE {_importance_sql()}, m AS ({METRICS_SQL}),
    back AS (SELECT *, row_number() OVER (PARTITION BY route, period ORDER BY date DESC) AS back FROM ft)
    SELECT 'model_metrics' AS name, count(*) AS n_rows, round(sum(round_even(hybrid_mape, 4) + round_even(hw_mape, 4)), 4) AS total FROM m
    UNION ALL SELECT 'forecasts', count(*), CAST(sum(CAST(trunc(hybrid_fc) AS BIGINT)) AS DOUBLE) FROM back WHERE period = 'test' OR back <= 52
    UNION ALL SELECT 'feature_importance', count(*), round(sum(importance), 2) FROM importance
    UNION ALL SELECT 'decompositions', count(DISTINCT route), round(sum(actual - hw_fc), 2) FROM back WHERE period = 'train' AND back <= 104""")
def _contents(spark, sf):
    tables = stages.forecast(enriched(spark, sf), STUMPS, STUMPS, base_year=BASE_YEAR, names=STUMP_FEATURES, params=STUMP_PARAMS)
    totals = {"model_metrics": F.round(F.sum(F.col("hybrid_mape") + F.col("hw_mape")), 4), "forecasts": F.sum("hybrid_fc").cast("double"),
              "feature_importance": F.round(F.sum("importance"), 2),
              "decompositions": F.round(F.sum(F.aggregate("residual", F.lit(0.0), lambda a, v: a + v)), 2)}
    folder = shared_folder(spark)
    export({name: tables[name] for name in totals}, folder)
    parts = [read_export(spark, folder, name).agg(F.count(F.lit(1)).alias("n_rows"), total.alias("total")).select(F.lit(name).alias("name"), "n_rows", "total")
             for name, total in totals.items()]
    return reduce(DataFrame.unionByName, parts)
