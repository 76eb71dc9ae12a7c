"""The three analyses as composed plans. Each returns named result tables; nothing runs until one is used, apart from
the tables the forecast writes in between."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import half_even
from panelflume.operators import (allocation, did, elasticity, features, filters, hybrid, metrics, smoothing, unitroot)
from panelflume.sources.files import cut_lineage
from panelflume.sources.lookups import lookup, values_table


def forecast(panel: DataFrame, trees: int = fv.BOOST_PARAMS["trees"], cv_trees: int = fv.CV_TREES,
             draws: int = fv.BOOTSTRAP_DRAWS, repeats: int = fv.IMPORTANCE_REPEATS, leak_free: bool = False,
             base_year: int = fv.BASE_YEAR, names: list[str] | None = None, params: dict | None = None) -> dict[str, DataFrame]:
    """model_metrics, forecasts, feature_importance, cv_results and decompositions of an enriched panel. hybrid.left_out() lists the routes
    that are too short for them. names: the features of the residual model (all); params: see hybrid.fit_residuals."""
    panel = cut_lineage(panel)
    feat = features.add_features(panel, leak_free=leak_free, base_year=base_year)
    names = filters.present(feat, fv.FEATURE_COLS if names is None else names)
    frame = cut_lineage(hybrid.smoothed_frame(feat, names=names))
    cv = cut_lineage(hybrid.cross_validate(frame, trees=cv_trees, params=params))
    scored = cut_lineage(hybrid.boost(frame, trees, params))

    residuals = scored.filter(F.col("period") == "train").select(
        "route", "date", (F.col("actual") - F.col("hybrid_fc")).alias("residual"))
    test = hybrid.bootstrap_interval(scored.filter(F.col("period") == "test"), residuals, draws)
    train_rows = scored.filter(F.col("period") == "train")
    forecasts = hybrid.forecast_table(test.unionByName(train_rows, allowMissingColumns=True))

    smoothing_params = frame.groupBy("route").agg(*[F.first(c).alias(f"hw_{c}") for c in ("alpha", "beta", "gamma")])
    adf = unitroot.adf(panel).select("route", "adf_t_stat", "adf_p", "is_stationary")
    table = (metrics.forecast_metrics(scored).join(hybrid.cv_summary(cv), "route", "left").join(smoothing_params, "route")
             .join(adf, "route", "left"))
    components = frame.filter(F.col("period") == "train").withColumnRenamed("actual", "y")
    return {
        "model_metrics": metrics.round_metrics(table),
        "forecasts": forecasts,
        "feature_importance": hybrid.importance(frame, names, trees, repeats, params),
        "cv_results": cv,
        "decompositions": smoothing.decomposition(components),
    }


def experiment_specs(spark: SparkSession, experiment: dict | None = None) -> DataFrame:
    e = experiment or fv.DID_EXPERIMENT
    return values_table(spark, did.SPEC_SHAPE, [(
        "default", e["treatment_date"], e["treatment_routes"], e["control_routes"], e["pre_weeks"], e["post_weeks"])])


def causal(panel: DataFrame, specs: DataFrame | None = None, outcomes: list[str] | None = None,
           elasticity_start: str = fv.ELASTICITY_START) -> dict[str, DataFrame]:
    """did_results (one row per experiment and outcome) and elasticity (one row per route with enough rows)."""
    specs = experiment_specs(panel.sparkSession) if specs is None else specs
    estimates = did.group_means(did.estimate(panel, specs, outcomes or fv.DID_EXPERIMENT["outcomes"]))
    columns = ["experiment", "outcome", "att", "att_se", "att_t", "att_p", "att_ci_low", "att_ci_high", "significant",
               "parallel_trends_p", "parallel_ok", "n_obs", "naive_did", "group_means"]
    return {"did_results": estimates.select(*columns), "elasticity": elasticity_table(panel, elasticity_start)}


def elasticity_table(panel: DataFrame, start: str | None = fv.ELASTICITY_START,
                     least: int = fv.ELASTICITY_MIN_OBS) -> DataFrame:
    """Elasticities per route on rows from `start` on, or all. The observation gate reads a count of the same aggregate."""
    recent = panel if start is None else panel.filter(F.col("date") >= F.lit(start).cast("date"))
    columns = ["route", "n", "ols_elasticity", "ols_se", "ols_t", "ols_p", "ols_r2", "iv_elasticity", "iv_se", "iv_t",
               "iv_p", "stage1_fstat", "hausman_stat", "hausman_p", "endogenous", "preferred_elasticity"]
    return elasticity.estimate(recent, least=least).select(*columns)


def allocate(forecasts: DataFrame, panel: DataFrame, flights: DataFrame | None = None,
             base_yield: float = fv.BASE_YIELD, parameters: dict | None = None) -> dict[str, DataFrame]:
    """lp_results and lp_sensitivity per route. The sweep uses unscaled yields."""
    flights = lookup(panel.sparkSession, "daily_flights") if flights is None else flights
    panel = panel.select("route", "yield_aud")
    demand = allocation.flight_demand(forecasts, flights)
    if parameters:
        demand = demand.withColumns({k: F.lit(v) for k, v in parameters.items()})
    scaled = allocation.scaled_yields(demand, panel, base_yield)
    solved = allocation.optimise(scaled)
    results = solved.select(
        "route", half_even(F.col("forecast_pax"), 0).cast("long").alias("forecast_pax"),
        *[f"{c}_seats" for c in fv.CABINS], *[f"{c}_pct" for c in fv.CABINS], "expected_revenue", "flat_baseline_rev",
        "revenue_uplift_pct", "bid_price_eco", "lp_success")
    return {"lp_results": results,
            "lp_sensitivity": allocation.sensitivity(demand, ["route"], high=fv.STAGE_SWEEP_HIGH)}
