"""Price elasticity of demand per entity: log-log OLS, two-stage least squares and the Hausman comparison.

Both estimators, the first-stage statistics and all errors come from one moment table per entity, so the panel is read
and aggregated once.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import cyclic_cos, cyclic_sin
from panelflume.functions.shapes import record
from panelflume.functions.tails import chi2_1_tail, t_tail
from panelflume.operators.filters import present
from panelflume.operators.regression import fit, moments, scaled_pinv, square

_FIELDS = ["ols_elasticity", "ols_se", "ols_t", "ols_p", "ols_r2", "iv_elasticity", "iv_se", "iv_t", "iv_p",
           "stage1_fstat", "hausman_stat", "hausman_p", "iv_se_corrected", "stage1_partial_f"]
_DIGITS = {"ols_t": 3, "iv_t": 3, "stage1_fstat": 2, "stage1_partial_f": 2}


def log_columns(df: DataFrame) -> DataFrame:
    """ln_pax, ln_yield and ln_fuel, NULL where pax is not positive, and the week encoding where it is absent."""
    sold = F.col("pax") > 0
    out = df.withColumns({
        "ln_pax": F.when(sold, F.ln("pax")), "ln_yield": F.when(sold, F.ln("yield_aud")),
        "ln_fuel": F.when(sold, F.ln("fuel_index"))})
    if "week_sin" not in out.columns:
        week = F.col("week_of_year")
        out = out.withColumns({"week_sin": cyclic_sin(week, fv.SEASON_WEEKS),
                               "week_cos": cyclic_cos(week, fv.SEASON_WEEKS)})
    return out


def two_stage(n: float, mean: np.ndarray, cov: np.ndarray) -> tuple:
    """All estimates for one entity. Variables are ordered price, instrument, controls..., demand."""
    p = len(mean)
    price, instrument, demand = 0, 1, p - 1
    controls = list(range(2, p - 1))
    k = p - 1  # constant, price (or instrument), controls

    b, v, _, _, sse, sst = fit(n, mean, cov, [price, *controls], demand, k)
    ols, ols_se = b[0], np.sqrt(max(v[0, 0], 0.0))

    exog = [instrument, *controls]
    first, v1, _, _, rss, tss = fit(n, mean, cov, exog, price, k)
    stage1_f = (tss - rss) / (rss / (n - k)) if rss > 0 else np.nan
    partial_f = first[0] ** 2 / v1[0, 0] if v1[0, 0] > 0 else np.nan

    # Second stage: regressors are the fitted price and the controls, both linear in the exogenous variables.
    to_fit = np.eye(len(exog))
    to_fit[0] = first
    s_xx = to_fit @ cov[np.ix_(exog, exog)] @ to_fit.T
    s_xy = to_fit @ cov[exog, demand]
    inv = scaled_pinv(s_xx, np.concatenate([[mean[price]], mean[controls]]))
    b2 = inv @ s_xy
    sse2 = max(n * (cov[demand, demand] - b2 @ s_xy), 0.0)
    iv, iv_se = b2[0], np.sqrt(max(sse2 / (n - k) * inv[0, 0] / n, 0.0))

    actual = [price, *controls]
    true_sse = n * (cov[demand, demand] - 2 * b2 @ cov[actual, demand] + b2 @ cov[np.ix_(actual, actual)] @ b2)
    iv_se_corrected = np.sqrt(max(true_sse / (n - k) * inv[0, 0] / n, 0.0))

    h = (ols - iv) ** 2 / abs(iv_se ** 2 - ols_se ** 2 + 1e-10)
    ols_t, iv_t = ols / max(ols_se, 1e-10), iv / max(iv_se, 1e-10)
    p_ols, p_iv = t_tail([ols_t, iv_t], n - k)
    return (ols, ols_se, ols_t, p_ols, 1 - sse / sst if sst > 0 else np.nan, iv, iv_se, iv_t, p_iv, stage1_f, h,
            float(chi2_1_tail(h)), iv_se_corrected, partial_f)


@F.pandas_udf(record(**{f: "double" for f in _FIELDS}))
def _solve(n: pd.Series, means: pd.Series, covs: pd.Series) -> pd.DataFrame:
    rows = []
    for n_i, mean, upper in zip(n, means, covs):
        mean = np.asarray(mean, float)
        if n_i <= len(mean):
            rows.append((np.nan,) * len(_FIELDS))
            continue
        rows.append(two_stage(float(n_i), mean, square(np.asarray(upper, float), len(mean))))
    return pd.DataFrame(rows, columns=_FIELDS)


def estimate(df: DataFrame, keys: list[str] | None = None, controls: list[str] | None = None,
             rounded: bool = True, least: int = 0) -> DataFrame:
    """One row per entity with at least `least` rows: OLS and IV elasticities, Hausman test, preferred estimate.

    Controls that the table lacks are left out. iv_se_corrected and stage1_partial_f are the textbook forms of the
    second-stage error and the instrument test.
    """
    keys = keys or ["route"]
    logs = log_columns(df)
    used = present(logs, fv.ELASTICITY_CONTROLS if controls is None else controls)
    table = moments(logs, ["ln_yield", "ln_fuel", *used, "ln_pax"], keys)
    solved = table.filter((F.col("n_rows") >= least) & (F.col("n") > 0)).withColumn("fit", _solve("n", "means", "covs"))
    out = solved.select(*keys, "n", "fit.*")
    endogenous = F.coalesce(F.col("hausman_p") < 0.05, F.lit(False))
    preferred = F.when(endogenous, F.col("iv_elasticity")).otherwise(F.col("ols_elasticity"))
    out = out.withColumn("endogenous", endogenous).withColumn("preferred_elasticity", preferred)
    if rounded:
        cols = [*_FIELDS, "preferred_elasticity"]
        out = out.withColumns({c: F.bround(c, _DIGITS.get(c, 4)) for c in cols})
    return out


def hausman(df: DataFrame) -> DataFrame:
    """Add hausman_stat from columns ols_elasticity, ols_se, iv_elasticity, iv_se."""
    gap = F.col("ols_elasticity") - F.col("iv_elasticity")
    spread = F.abs(F.col("iv_se") * F.col("iv_se") - F.col("ols_se") * F.col("ols_se") + F.lit(1e-10))
    return df.withColumn("hausman_stat", gap * gap / spread)
