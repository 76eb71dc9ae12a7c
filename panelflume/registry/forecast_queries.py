"""Queries on smoothing, forecasts, accuracy, intervals and importance."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from panelflume import fixed_values as fv
from panelflume.operators import filters, hybrid, metrics, residual_model, smoothing, smoothing_blocks
from panelflume.plans import stages
from panelflume.registry.base import (BASE_YEAR, DAY, FEATURES, PANEL, enriched, feature_frame, iso, panel, query,
                                      rounded)
from panelflume.sources.files import cut_lineage

QUARTER, FIXED = 13, (0.3, 0.1, 0.15)


# Holt-Winters ------------------------------------------------------------------------------------------------------

def smoothing_sql(source: str, params: str, season: int) -> str:
    """CTE `rec`: one row per route, parameter set and period, by recursion over periods.

    `source` is a relation (route, date, y); `params` a VALUES list (pid, a, b, g).
    """
    return f"""ser AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS t,
      count(*) OVER (PARTITION BY route) AS n FROM {source}),
  par AS (SELECT * FROM (VALUES {params}) AS p(pid, a, b, g)),
  ini AS (SELECT route, CASE WHEN any_value(n) >= {2 * season} THEN avg(y) FILTER (t < {season}) ELSE min(y) FILTER (t = 0) END AS l0,
      CASE WHEN any_value(n) >= {2 * season} THEN (avg(y) FILTER (t >= {season} AND t < {2 * season}) - avg(y) FILTER (t < {season})) / {season}
        ELSE (min(y) FILTER (t = n - 1) - min(y) FILTER (t = 0)) / greatest(any_value(n) - 1, 1) END AS t0,
      any_value(n) >= {season} AS seasonal, min(y) FILTER (t = 0) AS y0 FROM ser GROUP BY route),
  rec AS (
    SELECT i.route, pid, a, b, g, CAST(0 AS BIGINT) AS t, l0 AS l, t0 AS tr, [CASE WHEN seasonal THEN y0 - l0 ELSE 0 END] AS s,
      CASE WHEN seasonal THEN y0 - l0 ELSE 0 END AS s0, CAST(0 AS DOUBLE) AS sp, y0 AS y, l0 + t0 + CASE WHEN seasonal THEN y0 - l0 ELSE 0 END AS fitted
    FROM ini i, par
    UNION ALL
    SELECT route, pid, a, b, g, t, nl, nt, CASE WHEN len(s) < {season} THEN list_append(s, g * (y - nl) + (1 - g) * sp)
        ELSE list_append(s[2:], g * (y - nl) + (1 - g) * sp) END, s0, sp, y, nl + nt + sp
    FROM (SELECT *, b * (nl - l) + (1 - b) * tr AS nt FROM (
      SELECT *, a * (y - sp) + (1 - a) * (l + tr) AS nl FROM (
        SELECT r.route, r.pid, r.a, r.b, r.g, ser.t, r.l, r.tr, r.s, r.s0, ser.y,
          CASE WHEN ser.t >= {season} THEN r.s[1] ELSE 0 END AS sp
        FROM rec r JOIN ser ON ser.route = r.route AND ser.t = r.t + 1))))"""


ONE = f"(0, {FIXED[0]}::DOUBLE, {FIXED[1]}::DOUBLE, {FIXED[2]}::DOUBLE)"
GRID = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {g}::DOUBLE)" for i, (a, b, g) in enumerate(smoothing.GRID.round(2).tolist()))
SERIES = "(SELECT route, date, CAST(pax AS DOUBLE) AS y FROM panel)"
HW = f"WITH RECURSIVE {PANEL}, {smoothing_sql(SERIES, ONE, QUARTER)} "
HW_DAY = "strftime(ser.date, '%Y-%m-%d') AS date"
HW_JOIN = "FROM rec JOIN ser ON ser.route = rec.route AND ser.t = rec.t"


def _smoothed(spark, sf):
    return smoothing.smooth(smoothing.series(panel(spark, sf)), *FIXED, season=QUARTER)


@query("h01_holt_winters", HW + f"SELECT rec.route, {HW_DAY}, round(l, 4) AS level, round(tr, 4) AS trend, round(fitted, 4) AS fitted {HW_JOIN}")
def holt_winters(spark, sf):
    rows = smoothing.fitted_rows(_smoothed(spark, sf), QUARTER)
    return rounded(rows.select("route", "date", "level", "trend", "fitted"), {"level": 4, "trend": 4, "fitted": 4})


@query("h01_one_step_ahead", HW + f"""SELECT rec.route, {HW_DAY}, round(CASE WHEN rec.t = 0 THEN fitted ELSE
    lag(l) OVER w + lag(tr) OVER w + sp END, 4) AS fitted {HW_JOIN} WINDOW w AS (PARTITION BY rec.route ORDER BY rec.t)""")
def _one_step(spark, sf):
    state = smoothing.smooth(smoothing.series(panel(spark, sf)), *FIXED, season=QUARTER, one_step_ahead=True)
    return rounded(smoothing.fitted_rows(state, QUARTER).select("route", "date", "fitted"), {"fitted": 4})


@query("h02_grid_search", f"""WITH RECURSIVE {PANEL}, {smoothing_sql(SERIES, GRID, 52)},
    err AS (SELECT route, pid, any_value(a) AS alpha, any_value(b) AS beta, any_value(g) AS gamma, sqrt(avg(power(y - fitted, 2))) AS rmse
      FROM rec GROUP BY route, pid)
    SELECT route, alpha, beta, gamma, round(rmse, 4) AS rmse FROM err
    QUALIFY row_number() OVER (PARTITION BY route ORDER BY rmse, pid) = 1""")
def grid_search(spark, sf):
    fitted = smoothing.grid_fit(smoothing.series(panel(spark, sf)))
    return rounded(fitted.select("route", "alpha", "beta", "gamma", "rmse"), {"rmse": 4})


@query("h03_forecast", HW + """SELECT route, CAST(h AS INTEGER) AS step, round(l + h * tr + s[1 + (h - 1) % 13], 4) AS hw_fc
    FROM (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY route ORDER BY t DESC) = 1), generate_series(1, 52) g(h)""")
def _ahead(spark, sf):
    return rounded(smoothing.forecast_rows(_smoothed(spark, sf), 52, QUARTER), {"hw_fc": 4})


@query("h04_components", HW + f"""SELECT rec.route, {HW_DAY}, round(l, 4) AS level, round(tr, 4) AS trend,
    round(CASE WHEN rec.t >= 13 THEN sp ELSE s0 END, 4) AS seasonal, round(rec.y - fitted, 4) AS residual {HW_JOIN}""")
def _components(spark, sf):
    rows = smoothing.fitted_rows(_smoothed(spark, sf), QUARTER)
    cols = ["level", "trend", "seasonal", "residual"]
    return rounded(rows.select("route", "date", *cols), {c: 4 for c in cols})


@query("h05_decomposition", HW + """SELECT route, string_agg(date, ',' ORDER BY t) AS dates, round(sum(l), 2) AS level_sum,
    round(sum(residual), 2) AS residual_sum, count(*) AS weeks FROM (
      SELECT rec.route, rec.t, strftime(ser.date, '%Y-%m-%d') AS date, l, rec.y - fitted AS residual,
        row_number() OVER (PARTITION BY rec.route ORDER BY rec.t DESC) AS back
      FROM rec JOIN ser ON ser.route = rec.route AND ser.t = rec.t) WHERE back <= 104 GROUP BY route""")
def _decomposition(spark, sf):
    d = smoothing.decomposition(smoothing.fitted_rows(_smoothed(spark, sf), QUARTER))

    def total(c):
        return F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 2)

    return d.select("route", F.array_join("dates", ",").alias("dates"), total("level").alias("level_sum"),
                    total("residual").alias("residual_sum"), F.size("dates").cast("long").alias("weeks"))


# The yearly season, by the prefix over blocks of two years.
YEAR = 52
HW_YEAR = f"WITH RECURSIVE {PANEL}, {smoothing_sql(SERIES, ONE, YEAR)} "


def _yearly(spark, sf):
    return smoothing_blocks.smooth(panel(spark, sf), *FIXED, season=YEAR, bucket=F.year("date"), block_rows=2 * YEAR)


@query("h01_holt_winters_yearly", HW_YEAR + f"SELECT rec.route, {HW_DAY}, round(l, 4) AS level, round(tr, 4) AS trend, round(fitted, 4) AS fitted {HW_JOIN}")
def _hw_yearly(spark, sf):
    return rounded(_yearly(spark, sf).select("route", "date", "level", "trend", "fitted"), {"level": 4, "trend": 4, "fitted": 4})


@query("h03_forecast_yearly", HW_YEAR + f"""SELECT route, CAST(h AS INTEGER) AS step, round(l + h * tr + CASE WHEN len(s) >= {YEAR} THEN s[1 + (h - 1) % {YEAR}] ELSE 0 END, 4) AS hw_fc
    FROM (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY route ORDER BY t DESC) = 1), generate_series(1, 104) g(h)""")
def _ahead_yearly(spark, sf):
    return rounded(smoothing_blocks.forecast(_yearly(spark, sf), 104, YEAR), {"hw_fc": 4})


@query("h04_components_yearly", HW_YEAR + f"""SELECT rec.route, {HW_DAY}, round(l, 4) AS level, round(tr, 4) AS trend,
    round(CASE WHEN rec.t >= {YEAR} THEN sp ELSE s0 END, 4) AS seasonal, round(rec.y - fitted, 4) AS residual {HW_JOIN}""")
def _components_yearly(spark, sf):
    cols = ["level", "trend", "seasonal", "residual"]
    return rounded(_yearly(spark, sf).select("route", "date", *cols), {c: 4 for c in cols})


@query("h05_decomposition_yearly", HW_YEAR + """SELECT route, string_agg(date, ',' ORDER BY t) AS dates, round(sum(l), 2) AS level_sum,
    round(sum(residual), 2) AS residual_sum, count(*) AS weeks FROM (
      SELECT rec.route, rec.t, strftime(ser.date, '%Y-%m-%d') AS date, l, rec.y - fitted AS residual,
        row_number() OVER (PARTITION BY rec.route ORDER BY rec.t DESC) AS back
      FROM rec JOIN ser ON ser.route = rec.route AND ser.t = rec.t) WHERE back <= 104 GROUP BY route""")
def _decomposition_yearly(spark, sf):
    d = smoothing.decomposition(_yearly(spark, sf))

    def total(c):
        return F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 2)

    return d.select("route", F.array_join("dates", ",").alias("dates"), total("level").alias("level_sum"),
                    total("residual").alias("residual_sum"), F.size("dates").cast("long").alias("weeks"))


@query("i01_residual_target_yearly", HW_YEAR + f"SELECT rec.route, {HW_DAY}, round(rec.y - fitted, 4) AS residual {HW_JOIN}")
def _target_yearly(spark, sf):
    return rounded(_yearly(spark, sf).select("route", "date", "residual"), {"residual": 4})


# Holt-Winters on the part of each route the hybrid trains on: rows from the 53rd to the 27th last. `won` has the best
# parameters, `hw` a row per training and test row.
TRAINED = f"""{PANEL}, kept AS (SELECT route, date, CAST(pax AS DOUBLE) AS y, row_number() OVER (PARTITION BY route ORDER BY date) AS rn,
      count(*) OVER (PARTITION BY route) AS total FROM panel),
    {smoothing_sql('(SELECT route, date, y FROM kept WHERE rn > 52 AND rn <= total - 26)', GRID, 52)},
    won AS (SELECT route, pid, any_value(a) AS alpha, any_value(b) AS beta, any_value(g) AS gamma FROM rec GROUP BY route, pid
      QUALIFY row_number() OVER (PARTITION BY route ORDER BY avg(power(y - fitted, 2)), pid) = 1),
    mine AS (SELECT rec.* FROM rec JOIN won ON won.route = rec.route AND won.pid = rec.pid),
    final AS (SELECT * FROM mine QUALIFY row_number() OVER (PARTITION BY route ORDER BY t DESC) = 1),
    hw AS (SELECT m.route, ser.date, 'train' AS period, m.y AS actual, m.fitted AS hw_fc FROM mine m JOIN ser ON ser.route = m.route AND ser.t = m.t
      UNION ALL SELECT k.route, k.date, 'test', k.y, greatest(f.l + h * f.tr + CASE WHEN len(f.s) >= 52 THEN f.s[1 + (h - 1) % 52] ELSE 0 END, 0)
      FROM (SELECT *, rn - (total - 26) AS h FROM kept WHERE rn > total - 26 AND rn > 52) k JOIN final f ON f.route = k.route)"""
# The forecast table of the serving chain: Holt-Winters forecasts, and a correction that needs no fitted trees (the mean with
# the value four periods back), so that SQL can follow the whole chain.
CHAIN = f"""{TRAINED}, ft AS (SELECT route, date, period, CAST(actual AS BIGINT) AS actual, hw_fc,
      (hw_fc + coalesce(lag(actual, 4) OVER (PARTITION BY route ORDER BY date), hw_fc)) / 2.0::DOUBLE AS hybrid_fc FROM hw)"""


def chain_table(p):
    """Holt-Winters forecast table (route, date, period, actual, hw_fc, hybrid_fc) of a panel's rows from the 53rd on."""
    later = filters.numbered(p).filter(F.col("position") > fv.SEASON_WEEKS).drop("position", "n_rows")
    frame = hybrid.smoothed_frame(later)
    back = F.coalesce(F.lag("actual", 4).over(filters.series_window()), F.col("hw_fc"))
    return frame.select("route", "date", "period", F.col("actual").cast("long").alias("actual"), "hw_fc",
                        ((F.col("hw_fc") + back) / F.lit(2.0)).alias("hybrid_fc"), "alpha", "beta", "gamma")


NAIVE = f"""{PANEL}, numbered AS (SELECT *, lag(pax, 52) OVER w AS hw_fc, (lag(pax, 52) OVER w + lag(pax, 4) OVER w) / 2.0::DOUBLE AS hybrid_fc,
      row_number() OVER w AS rn, count(*) OVER (PARTITION BY route) AS n FROM panel WINDOW w AS (PARTITION BY route ORDER BY date)),
    ft AS (SELECT route, date, CASE WHEN rn > n - 26 THEN 'test' ELSE 'train' END AS period, pax AS actual, CAST(hw_fc AS DOUBLE) AS hw_fc,
      hybrid_fc FROM numbered WHERE hw_fc IS NOT NULL)"""


def naive_table(p):
    """Forecast table of two simple rules: the value 52 periods back, and its mean with the value 4 periods back."""
    w = filters.series_window()
    split = filters.holdout_split(p, fv.TEST_WEEKS)
    out = split.withColumns({"hw_fc": F.lag("pax", 52).over(w).cast("double"),
                             "hybrid_fc": (F.lag("pax", 52).over(w) + F.lag("pax", 4).over(w)) / F.lit(2.0)})
    return out.filter(F.col("hw_fc").isNotNull()).select(
        "route", "date", "period", F.col("pax").alias("actual"), "hw_fc", "hybrid_fc")


def _test(spark, sf):
    return naive_table(panel(spark, sf)).filter(F.col("period") == "test")


@query("h08_seasonal_naive", f"WITH {NAIVE} SELECT route, round(avg(abs((actual - hw_fc) / actual)), 8) AS mape FROM ft WHERE period = 'test' GROUP BY route")
def _naive(spark, sf):
    t = _test(spark, sf)
    return rounded(t.groupBy("route").agg(metrics.mape(F.col("actual"), F.col("hw_fc")).alias("mape")), {"mape": 8})


# Accuracy ----------------------------------------------------------------------------------------------------------

@query("d04_mape", f"WITH {NAIVE} SELECT route, period, round(avg(abs((actual - hybrid_fc) / actual)), 8) AS mape FROM ft GROUP BY 1, 2")
def _mape(spark, sf):
    t = naive_table(panel(spark, sf))
    return rounded(t.groupBy("route", "period").agg(metrics.mape(F.col("actual"), F.col("hybrid_fc")).alias("mape")), {"mape": 8})


@query("d05_rmse", f"WITH {NAIVE} SELECT route, period, round(sqrt(avg(power(actual - hybrid_fc, 2))), 4) AS rmse FROM ft GROUP BY 1, 2")
def _rmse(spark, sf):
    t = naive_table(panel(spark, sf))
    return rounded(t.groupBy("route", "period").agg(metrics.rmse(F.col("actual"), F.col("hybrid_fc")).alias("rmse")), {"rmse": 4})


R2 = "1 - sum(power(actual - hybrid_fc, 2)) / sum(power(actual - mean, 2))"


@query("d06_r2", f"WITH {NAIVE} SELECT route, round({R2}, 8) AS r2 FROM (SELECT *, avg(actual) OVER (PARTITION BY route) AS mean FROM ft) GROUP BY route")
def _r2(spark, sf):
    t = naive_table(panel(spark, sf))
    return rounded(t.groupBy("route").agg(metrics.r2(F.col("actual"), F.col("hybrid_fc")).alias("r2")), {"r2": 8})


METRICS_SQL = f"""SELECT route, count(*) FILTER (period = 'train') AS n_train, count(*) FILTER (period = 'test') AS n_test,
    avg(abs((actual - hw_fc) / actual)) FILTER (period = 'test') AS hw_mape,
    avg(abs((actual - hybrid_fc) / actual)) FILTER (period = 'test') AS hybrid_mape,
    sqrt(avg(power(actual - hybrid_fc, 2)) FILTER (period = 'test')) AS hybrid_rmse,
    1 - sum(power(actual - hybrid_fc, 2)) FILTER (period = 'test') / sum(power(actual - mean, 2)) FILTER (period = 'test') AS hybrid_r2
    FROM (SELECT *, avg(actual) OVER (PARTITION BY route, period) AS mean FROM ft) GROUP BY route"""


@query("d07_improvement", f"WITH {NAIVE}, m AS ({METRICS_SQL}) SELECT route, round((hw_mape - hybrid_mape) / hw_mape * 100, 6) AS mape_improvement_pct FROM m")
def _improvement(spark, sf):
    return rounded(metrics.forecast_metrics(naive_table(panel(spark, sf))).select("route", "mape_improvement_pct"), {"mape_improvement_pct": 6})


FOLD_ROWS = """tr AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY route) AS m
      FROM ft WHERE period = 'train'),
    folds AS (SELECT tr.*, f AS fold, CASE WHEN pos < m - (4 - f) * 8 THEN 'train' ELSE 'val' END AS role FROM tr, generate_series(1, 3) g(f)
      WHERE pos < m - (4 - f) * 8 + 8)"""
FOLDS = f"{NAIVE}, {FOLD_ROWS}"


def _folds(spark, sf):
    train = naive_table(panel(spark, sf)).filter(F.col("period") == "train")
    return filters.walk_forward(train, fv.CV_FOLDS, fv.CV_FOLD_WEEKS)


@query("i05_walk_forward", f"WITH {FOLDS} SELECT route, {DAY}, CAST(fold AS INTEGER) AS fold, role FROM folds")
def _walk(spark, sf):
    return iso(_folds(spark, sf).select("route", "date", "fold", "role"))


@query("d08_cv_summary", f"""WITH {FOLDS}, c AS (SELECT route, fold, avg(abs((actual - hybrid_fc) / actual)) AS mape FROM folds
    WHERE role = 'val' GROUP BY 1, 2) SELECT route, round(avg(mape), 8) AS cv_mape_mean, round(stddev_pop(mape), 8) AS cv_mape_std FROM c GROUP BY route""")
def _cv_summary(spark, sf):
    val = _folds(spark, sf).filter(F.col("role") == "val")
    cv = val.groupBy("route", "fold").agg(metrics.mape(F.col("actual"), F.col("hybrid_fc")).alias("mape"))
    return rounded(hybrid.cv_summary(cv), {"cv_mape_mean": 8, "cv_mape_std": 8})


@query("d09_cross_entity_mean", f"""WITH {NAIVE}, m AS ({METRICS_SQL}) SELECT round(avg(hw_mape), 8) AS hw_mape, round(avg(hybrid_mape), 8) AS hybrid_mape FROM m""")
def _across(spark, sf):
    m = metrics.forecast_metrics(naive_table(panel(spark, sf)))
    return rounded(m.agg(F.avg("hw_mape").alias("hw_mape"), F.avg("hybrid_mape").alias("hybrid_mape")), {"hw_mape": 8, "hybrid_mape": 8})


@query("d11_percentile", f"""WITH {NAIVE} SELECT route, round(quantile_cont(CAST(actual AS DOUBLE), 0.025), 6) AS low,
    round(quantile_cont(CAST(actual AS DOUBLE), 0.975), 6) AS high FROM ft GROUP BY route""")
def _percentile(spark, sf):
    out = metrics.percentiles(naive_table(panel(spark, sf)), "actual", [0.025, 0.975], "route").withColumnRenamed("percentiles", "q")
    return rounded(out.select("route", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high")), {"low": 6, "high": 6})


@query("d15_share_of_max", f"WITH {PANEL}, m AS (SELECT route, month, sum(pax) AS pax FROM panel GROUP BY 1, 2) SELECT route, month, round(pax / max(pax) OVER (PARTITION BY route), 8) AS share_of_max FROM m")
def _share(spark, sf):
    m = panel(spark, sf).groupBy("route", "month").agg(F.sum("pax").alias("pax"))
    return rounded(metrics.share_of_max(m, "pax").select("route", "month", "share_of_max"), {"share_of_max": 8})


@query("i11_forecast_table", f"""WITH RECURSIVE {CHAIN}, r AS (SELECT *, row_number() OVER (PARTITION BY route, period ORDER BY date DESC) AS back FROM ft)
    SELECT route, {DAY}, period, actual, CAST(trunc(hybrid_fc) AS BIGINT) AS hybrid_fc, CAST(trunc(hw_fc) AS BIGINT) AS hw_fc,
      CASE WHEN period = 'test' THEN CAST(trunc(greatest(hybrid_fc - 500.5, 0)) AS BIGINT) END AS ci_low,
      CASE WHEN period = 'test' THEN CAST(trunc(hybrid_fc + 500.5) AS BIGINT) END AS ci_high
    FROM r WHERE period = 'test' OR back <= 52""")
def _table(spark, sf):
    t = chain_table(panel(spark, sf)).withColumns({"ci_low": F.col("hybrid_fc") - 500.5, "ci_high": F.col("hybrid_fc") + 500.5})
    return iso(hybrid.forecast_table(t))


@query("f04_union_with_nulls", f"""WITH {NAIVE} SELECT route, {DAY}, period, CASE WHEN period = 'test' THEN hw_fc END AS test_fc FROM ft""")
def _union(spark, sf):
    t = naive_table(panel(spark, sf))
    test = t.filter(F.col("period") == "test").select("route", "date", "period", F.col("hw_fc").alias("test_fc"))
    train = t.filter(F.col("period") == "train").select("route", "date", "period")
    return iso(test.unionByName(train, allowMissingColumns=True))


# Intervals ---------------------------------------------------------------------------------------------------------

@query("i08_bootstrap_interval", f"""WITH RECURSIVE {CHAIN}, te AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) AS step FROM ft WHERE period = 'test'),
    re AS (SELECT route, actual - hybrid_fc AS residual, row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS i,
      count(*) OVER (PARTITION BY route) AS m FROM ft WHERE period = 'train'),
    draws AS (SELECT te.route, te.date, te.step, hybrid_fc, b, CAST('0x' || substr(md5(concat_ws('|', te.route, step, b, 42)), 1, 12) AS BIGINT)
      % (SELECT max(m) FROM re WHERE re.route = te.route) AS i FROM te, generate_series(0, 299) g(b)),
    boot AS (SELECT d.*, greatest(d.hybrid_fc + re.residual, 0) AS v FROM draws d JOIN re ON re.route = d.route AND re.i = d.i)
    SELECT route, {DAY}, round(quantile_cont(CAST(v AS DOUBLE), 0.025), 4) AS ci_low, round(quantile_cont(CAST(v AS DOUBLE), 0.975), 4) AS ci_high
    FROM boot GROUP BY route, date""")
def bootstrap(spark, sf):
    t = cut_lineage(chain_table(panel(spark, sf)))
    residuals = t.filter(F.col("period") == "train").select("route", "date", (F.col("actual") - F.col("hybrid_fc")).alias("residual"))
    test = t.filter(F.col("period") == "test").withColumn("step", F.row_number().over(filters.series_window()))
    out = hybrid.bootstrap_interval(test, residuals)
    return rounded(out.select("route", "date", "ci_low", "ci_high"), {"ci_low": 4, "ci_high": 4})


# Residual model ----------------------------------------------------------------------------------------------------

@query("i01_residual_target", HW + f"SELECT rec.route, {HW_DAY}, round(rec.y - fitted, 4) AS residual {HW_JOIN}")
def _target(spark, sf):
    return rounded(smoothing.fitted_rows(_smoothed(spark, sf), QUARTER).select("route", "date", "residual"), {"residual": 4})


SCALED = ["week_sin", "pax_lag52", "rolling_mean_13w", "business_mix"]


@query("i02_standardise", f"WITH {FEATURES} SELECT route, {DAY}, " + ", ".join(
    f"round(({c} - avg({c}) OVER (PARTITION BY route)) / stddev_pop({c}) OVER (PARTITION BY route), 6) AS {c}" for c in SCALED)
       + " FROM feat WHERE pax_lag52 IS NOT NULL")
def _scaled(spark, sf):
    frame = feature_frame(spark, sf).select("route", "date", *SCALED)
    return rounded(metrics.standardise(frame, SCALED), {c: 6 for c in SCALED})


def _frame(spark, sf, **kw):
    return cut_lineage(hybrid.smoothed_frame(feature_frame(spark, sf, **kw)))


@query("i04_hybrid_forecast", f"""WITH RECURSIVE {TRAINED} SELECT route, {DAY}, period, actual, round(hw_fc, 4) AS hw_fc, true AS combines,
    true AS not_negative FROM hw""")
def hybrid_forecast(spark, sf):
    out = hybrid.boost(_frame(spark, sf))
    combines = F.abs(F.col("hybrid_fc") - F.greatest(F.col("hw_fc") + F.col("boost"), F.lit(0.0))) < 1e-9
    out = out.select("route", "date", "period", "actual", F.round("hw_fc", 4).alias("hw_fc"), combines.alias("combines"),
                     (F.col("hybrid_fc") >= 0).alias("not_negative"))
    return iso(out)


@query("i03_boosted_residuals", f"""WITH RECURSIVE {TRAINED} SELECT route, {DAY}, round(actual - hw_fc, 4) AS residual, true AS lowers_error
    FROM hw WHERE period = 'train'""")
def _boosted(spark, sf):
    scored = hybrid.boost(_frame(spark, sf)).filter(F.col("period") == "train")
    whole = Window.partitionBy("route")
    left = F.col("residual") - F.col("boost")
    lower = F.sum(left * left).over(whole) < F.sum(F.col("residual") * F.col("residual")).over(whole)
    return iso(scored.select("route", "date", F.round("residual", 4).alias("residual"), lower.alias("lowers_error")))


# Three stages of one stump each over features of few values, grown again in SQL: every threshold between two values of a
# feature is tried, as the trees do.
STUMP_FEATURES = ["school_holiday", "public_holiday", "year_idx", "is_summer", "is_winter"]
STUMPS = 3


def stumps_sql(rows: str, stages: int = STUMPS) -> str:
    """CTEs d0 to d<stages>: `rows` (fold, route, date, the features, lvl, residual, any others) with fc, the sum of the stumps so
    far. A fold's stumps are grown on its rows with a residual."""
    names = [*STUMP_FEATURES, "lvl"]
    grain = residual_model.GRAIN
    ctes = [f"d0 AS MATERIALIZED (SELECT *, round(residual / lvl * {grain}) / {grain} AS target, 0.0::DOUBLE AS fc FROM ({rows}))"]
    for k in range(stages):
        left = f"round((target - {residual_model.RATE} * fc) * {grain}) / {grain}"
        values = " UNION ALL ".join(f"SELECT fold, {i} AS f, {c} AS v, left_ FROM l{k}" for i, c in enumerate(names))
        side = " ".join(f"WHEN {i} THEN d.{c}" for i, c in enumerate(names))
        ctes += [f"l{k} AS (SELECT *, {left} AS left_ FROM d{k} WHERE target IS NOT NULL)",
                 f"v{k} AS (SELECT fold, f, v, count(*) AS n, sum(left_) AS s FROM ({values}) GROUP BY fold, f, v)",
                 f"""c{k} AS (SELECT fold, f, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                 sum(n) OVER (PARTITION BY fold, f) AS nn, sum(s) OVER (PARTITION BY fold, f) AS ss FROM v{k} WINDOW w AS (PARTITION BY fold, f ORDER BY v))""",
                 f"""b{k} AS MATERIALIZED (SELECT * FROM c{k} WHERE threshold IS NOT NULL AND nl >= {fv.BOOST_PARAMS['min_leaf']} AND nn - nl >= {fv.BOOST_PARAMS['min_leaf']}
                 QUALIFY row_number() OVER (PARTITION BY fold ORDER BY sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) DESC, f, threshold) = 1)""",
                 f"""d{k + 1} AS MATERIALIZED (SELECT d.* EXCLUDE (fc), d.fc + CASE WHEN CASE b.f {side} END <= threshold THEN sl / nl ELSE (ss - sl) / (nn - nl) END AS fc
                 FROM d{k} d JOIN b{k} b ON b.fold = d.fold)"""]
    return ", ".join(ctes)


AS_NUMBERS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in STUMP_FEATURES)


def _stumps_sql() -> str:
    rows = f"""SELECT 0 AS fold, route, date, {AS_NUMBERS}, CAST(pax - pax_lag52 AS DOUBLE) AS residual,
      avg(CAST(pax AS DOUBLE)) OVER (PARTITION BY route) AS lvl FROM feat WHERE pax_lag52 IS NOT NULL"""
    return f"""WITH {FEATURES}, {stumps_sql(rows)}
    SELECT route, {DAY}, round(lvl * {residual_model.RATE} * fc, 4) AS boost FROM d{STUMPS}"""


@query("i03_boosted_stumps", _stumps_sql())
def _stumps(spark, sf):
    feat = feature_frame(spark, sf)
    level = F.avg(F.col("pax").cast("double")).over(Window.partitionBy("route"))
    x = F.array(*[F.col(c).cast("double") for c in STUMP_FEATURES], level)
    rows = cut_lineage(feat.select("route", "date", (F.col("pax") - F.col("pax_lag52")).cast("double").alias("residual"), x.alias("x")))
    model = residual_model.fit(rows, STUMPS, 1, 1.0, fv.BOOST_PARAMS["min_leaf"], 1, stage_trees=1)
    return rounded(residual_model.predict(model, rows).select("route", "date", "boost"), {"boost": 4})


@query("i06_walk_forward_cv", f"""WITH {PANEL}, m AS (SELECT route, count(*) - 52 - 26 AS m FROM panel GROUP BY route HAVING m > 0)
    SELECT route, CAST(f AS INTEGER) AS fold, m - (4 - f) * 8 AS n_train, CAST(8 AS BIGINT) AS n_val, true AS measured
    FROM m, generate_series(1, 3) g(f)""")
def _cv(spark, sf):
    cv = hybrid.cross_validate(_frame(spark, sf))
    return cv.select("route", "fold", "n_train", "n_val", ((F.col("mape") >= 0) & (F.col("rmse") >= 0)).alias("measured"))


@query("i09_permutation_importance", f"""WITH {PANEL}, r AS (SELECT route FROM panel GROUP BY route HAVING count(*) > 78)
    SELECT route, feature_code, feature, CAST(30 AS BIGINT) AS ranks, true AS constants_are_zero
    FROM r, (VALUES {', '.join(f"('{c}', '{n}')" for c, n in fv.FEATURES)}) AS f(feature_code, feature)""")
def _importance(spark, sf):
    frame = _frame(spark, sf)
    table = hybrid.importance(frame, fv.FEATURE_COLS)
    spread = frame.filter(F.col("period") == "train").select("route", F.posexplode("x").alias("i", "v")).groupBy("route", "i").agg(
        (F.min("v").eqNullSafe(F.max("v"))).alias("constant"))
    codes = F.create_map(*[F.lit(v) for i, c in enumerate(fv.FEATURE_COLS) for v in (i, c)])
    constant = spread.select("route", F.try_element_at(codes, F.col("i")).alias("feature_code"), "constant")
    ranks = F.size(F.collect_set("rank").over(Window.partitionBy("route"))).cast("long")
    joined = table.withColumn("ranks", ranks).join(constant, ["route", "feature_code"], "left")
    fine = ~F.coalesce("constant", F.lit(False)) | ((F.col("importance") == 0) & (F.col("importance_std") == 0))
    return joined.select("route", "feature_code", "feature", "ranks", fine.alias("constants_are_zero"))


TRIED = ["pax_lag4", "pax_lag52", "rolling_mean_13w"]
_SHUFFLED = " UNION ALL ".join(
    f"""SELECT a.route, '{c}' AS feature_code, a.repeat, a.residual, (b.{c} + {' + '.join('a.' + o for o in TRIED if o != c)}) / 3.0::DOUBLE AS boost
    FROM (SELECT * FROM tr, generate_series(1, 15) g(repeat)) a
    JOIN (SELECT *, row_number() OVER (PARTITION BY route, repeat ORDER BY md5(concat_ws('|', route, '{c}', repeat, i))) - 1 AS place
      FROM tr, generate_series(1, 15) g(repeat)) b ON a.route = b.route AND a.repeat = b.repeat AND a.i = b.place""" for c in TRIED)


@query("i09_permutation_scoring", f"""WITH {FEATURES}, tr AS (SELECT route, date, CAST(pax AS DOUBLE) AS residual,
      CAST(pax_lag4 AS DOUBLE) AS pax_lag4, CAST(pax_lag52 AS DOUBLE) AS pax_lag52, rolling_mean_13w,
      row_number() OVER (PARTITION BY route ORDER BY date) - 1 AS i FROM feat WHERE pax_lag52 IS NOT NULL),
    sh AS ({_SHUFFLED}),
    base AS (SELECT route, avg(power(residual - (pax_lag4 + pax_lag52 + rolling_mean_13w) / 3, 2)) AS base FROM tr GROUP BY route),
    trial AS (SELECT route, feature_code, repeat, avg(power(residual - boost, 2)) AS mse FROM sh GROUP BY 1, 2, 3)
    SELECT t.route, feature_code, round(avg(mse - base), 3) AS importance, round(stddev_pop(mse - base), 3) AS importance_std,
      CAST(row_number() OVER (PARTITION BY t.route ORDER BY avg(mse - base) DESC) AS INTEGER) AS rank
    FROM trial t JOIN base b ON t.route = b.route GROUP BY t.route, feature_code""")
def _scoring(spark, sf):
    x = F.array(*[F.col(c).cast("double") for c in TRIED])
    feat = feature_frame(spark, sf).select("route", "date", F.col("pax").cast("double").alias("residual"), x.alias("x"))

    def predict(df):
        return df.withColumn("boost", (F.get("x", F.lit(0)) + F.get("x", F.lit(1)) + F.get("x", F.lit(2))) / F.lit(3.0))

    table = hybrid.importance_table(predict(feat), predict(hybrid.permuted(feat, TRIED, fv.IMPORTANCE_REPEATS)), len(TRIED))
    return rounded(table, {"importance": 3, "importance_std": 3})


@query("i10_feature_labels", f"""WITH {PANEL}, r AS (SELECT route, count(*) AS weeks FROM panel GROUP BY route)
    SELECT route, feature_code, feature, weeks FROM r, (VALUES """ + ", ".join(f"('{c}', '{n}')" for c, n in fv.FEATURES if c.startswith("pax")
       ) + ") AS t(feature_code, feature)")
def _labels(spark, sf):
    frame = feature_frame(spark, sf, drop_na=False)
    codes = F.explode(F.array(*[F.lit(c) for c in frame.columns if c.startswith("pax_")])).alias("feature_code")
    counted = frame.groupBy("route").agg(F.count("*").alias("weeks")).select("route", "weeks", codes)
    return hybrid.label(counted).select("route", "feature_code", "feature", "weeks")


@query("f02_sorted_desc", f"WITH {PANEL} SELECT route, month, CAST(sum(pax) AS BIGINT) AS pax FROM panel GROUP BY 1, 2 ORDER BY pax DESC")
def _desc(spark, sf):
    return panel(spark, sf).groupBy("route", "month").agg(F.sum("pax").alias("pax")).orderBy(F.col("pax").desc())


@query("f03_top_per_group", f"""WITH {PANEL}, m AS (SELECT route, month, sum(pax) AS pax FROM panel GROUP BY 1, 2)
    SELECT route, month, CAST(pax AS BIGINT) AS pax, CAST(row_number() OVER (PARTITION BY route ORDER BY pax DESC, month) AS INTEGER) AS rank
    FROM m QUALIFY rank <= 10""")
def _top(spark, sf):
    m = panel(spark, sf).groupBy("route", "month").agg(F.sum("pax").alias("pax"))
    return metrics.top_per_group(m, "pax", 10, tie="month").select("route", "month", "pax", "rank")
