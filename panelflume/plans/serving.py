"""Serving tables joined from the result tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def scorecard(model_metrics: DataFrame, elasticity: DataFrame, lp_results: DataFrame) -> DataFrame:
    """One row per route: accuracy, allocation uplift, preferred elasticity and unit-root p where available."""
    return (model_metrics.join(lp_results.select("route", "revenue_uplift_pct"), "route", "left")
            .join(elasticity.select("route", "preferred_elasticity"), "route", "left")
            .select("route", *[c for c in ("hw_mape", "hybrid_mape", "mape_improvement_pct", "hybrid_r2")
                               if c in model_metrics.columns],
                    "revenue_uplift_pct", "preferred_elasticity",
                    *[c for c in ("adf_p",) if c in model_metrics.columns]))


def headline(model_metrics: DataFrame, elasticity: DataFrame, did: DataFrame, lp_results: DataFrame,
             route: str, outcome: str = "yield_aud") -> DataFrame:
    """Headline figures as (kpi, value) rows."""
    def rows(df: DataFrame, **values) -> DataFrame:
        """One aggregate over df, its values as rows."""
        pairs = [F.struct(F.lit(k).alias("kpi"), v.cast("double").alias("value")) for k, v in values.items()]
        return df.agg(F.array(*pairs).alias("_rows")).select(F.inline("_rows"))

    chosen, effect = F.col("route") == route, F.col("outcome") == outcome
    return (rows(model_metrics, mean_hybrid_mape=F.avg("hybrid_mape"), mean_hw_mape=F.avg("hw_mape"))
            .unionByName(rows(lp_results, mean_uplift_pct=F.avg("revenue_uplift_pct")))
            .unionByName(rows(elasticity.filter(chosen), elasticity=F.max("preferred_elasticity")))
            .unionByName(rows(did.filter(effect), att=F.max("att"), n_obs=F.max("n_obs"))))
