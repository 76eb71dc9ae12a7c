"""Queries on regressions, difference-in-differences, elasticities and unit roots."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import unit_root_p
from panelflume.functions.tails import chi2_1_p, student_t_p
from panelflume.operators import did, did_rolling, elasticity, filters, hybrid, metrics, regression, unitroot
from panelflume.plans import stages
from panelflume.registry.base import (ENRICHED, EXPERIMENTS, PANEL, chi2_tail_sql, did_fit_sql, did_rows_sql, enriched,
                                      panel, panel_sql, query, rounded, sweep, t_tail_sql, BASE_YEAR)
from panelflume.registry.forecast_queries import CHAIN, FOLD_ROWS, METRICS_SQL, TRAINED, chain_table
from panelflume.sources import table
from panelflume.sources.files import cut_lineage, read_json, shared_folder, write_json
from panelflume.sources.lookups import values_table
from panelflume.sources.star import TABLE_SCHEMAS
from panelflume.streaming import did_updates, panel_state

E1 = EXPERIMENTS[:1]
OUTCOMES = ["yield_aud", "pax"]
DID = f"WITH {PANEL}, {did_rows_sql(E1)}, {did_fit_sql('d', 'po', 'f')} "
MANY = f"WITH {PANEL}, {did_rows_sql(EXPERIMENTS)}, {did_fit_sql('d', 'po', 'f')} "


def _specs(spark, rows=E1):
    return values_table(spark, did.SPEC_SHAPE, rows)


def _fitted(spark, sf):
    return did.from_cells(did.cell_moments(did.moments(panel(spark, sf), _specs(spark), OUTCOMES)))


@query("d02_cell_means", DID + """SELECT experiment, outcome, round(mean_0_0, 4) AS mean_0_0, round(mean_0_1, 4) AS mean_0_1,
    round(mean_1_0, 4) AS mean_1_0, round(mean_1_1, 4) AS mean_1_1 FROM f""")
def _cells(spark, sf):
    cols = [f"mean_{a}_{b}" for a in (0, 1) for b in (0, 1)]
    return rounded(_fitted(spark, sf).select("experiment", "outcome", *cols), {c: 4 for c in cols})


@query("j02_did_att", DID + """SELECT experiment, outcome, n_obs, round(mean_0_0, 4) AS alpha,
    round(mean_1_0 - mean_0_0, 4) AS beta_treated, round(mean_0_1 - mean_0_0, 4) AS beta_post, round(att, 4) AS att,
    round(att_se, 4) AS att_se, round(att / att_se, 4) AS att_t, round(att - 1.96 * att_se, 4) AS att_ci_low,
    round(att + 1.96 * att_se, 4) AS att_ci_high FROM f""")
def did_att(spark, sf):
    cols = ["alpha", "beta_treated", "beta_post", "att", "att_se", "att_t", "att_ci_low", "att_ci_high"]
    return rounded(_fitted(spark, sf).select("experiment", "outcome", "n_obs", *cols), {c: 4 for c in cols})


@query("a04_json_sink", DID + """SELECT outcome, n_obs, round(mean_0_0, 4) AS control_pre, round(mean_0_1, 4) AS control_post,
    round(mean_1_0, 4) AS treated_pre, round(mean_1_1, 4) AS treated_post FROM f""")
def _json_sink(spark, sf):
    folder = shared_folder(spark)
    write_json(did.group_means(_fitted(spark, sf)).select("outcome", "n_obs", "group_means"), f"{folder}/did_results")
    back = read_json(spark, f"{folder}/did_results", "outcome string, n_obs bigint, group_means map<string,double>")
    names = {"control_pre": "0_0", "control_post": "0_1", "treated_pre": "1_0", "treated_post": "1_1"}
    return back.select("outcome", "n_obs", *[F.round(F.col("group_means")[k], 4).alias(n) for n, k in names.items()])


@query("j03_naive_did", DID + "SELECT outcome, round(att, 4) AS naive_did FROM f")
def _naive(spark, sf):
    return rounded(_fitted(spark, sf).select("outcome", "naive_did"), {"naive_did": 4})


@query("j06_did_hc1", DID + "SELECT outcome, round(att_se_hc1, 4) AS att_se, round(att / att_se_hc1, 4) AS att_t FROM f")
def _hc1(spark, sf):
    out = did.estimate(panel(spark, sf), _specs(spark), OUTCOMES, se_type="hc1", p_values=False)
    return rounded(out.select("outcome", "att_se", "att_t"), {"att_se": 4, "att_t": 4})


def _placebo_ctes(experiments):
    return f"""{did_rows_sql(experiments)}, {did_fit_sql('d', 'po', 'f')},
  pre AS (SELECT * EXCLUDE (po) FROM d WHERE po = 0),
  pp AS (SELECT *, CAST(date >= min(date) OVER (PARTITION BY experiment) + CAST(pre_weeks // 2 AS INTEGER) * 7 AS INTEGER)
    AS pseudo FROM pre), {did_fit_sql('pp', 'pseudo', 'q')}"""


@query("j04_parallel_trends", f"""WITH {PANEL}, {_placebo_ctes(EXPERIMENTS)} SELECT experiment, outcome,
    n_obs AS parallel_trends_n, round(att / greatest(att_se, 1e-10), 4) AS parallel_trends_t FROM q""")
def _parallel(spark, sf):
    moments = did.moments(panel(spark, sf), _specs(spark, EXPERIMENTS), OUTCOMES)
    return rounded(did.fit_tests(moments).select("experiment", "outcome", "parallel_trends_n", "parallel_trends_t"),
                   {"parallel_trends_t": 4})


@query("j05_multi_outcome", DID + "SELECT outcome, n_obs, round(att, 4) AS att, round(att_se, 4) AS att_se FROM f")
def _multi(spark, sf):
    return rounded(_fitted(spark, sf).select("outcome", "n_obs", "att", "att_se"), {"att": 4, "att_se": 4})


@query("j07_many_experiments", f"""WITH {PANEL}, {_placebo_ctes(EXPERIMENTS)} SELECT f.experiment, f.outcome, f.n_obs,
    round(f.att, 4) AS att, round(f.att_se, 4) AS att_se, round({t_tail_sql('f.att / f.att_se', 'f.n_obs - 4')}, 6) AS att_p,
    round({t_tail_sql('q.att / q.att_se', 'q.n_obs - 4')}, 6) AS parallel_trends_p,
    {t_tail_sql('f.att / f.att_se', 'f.n_obs - 4')} < 0.05 AS significant
    FROM f JOIN q USING (experiment, outcome)""")
def _many(spark, sf):
    out = did.estimate(panel(spark, sf), _specs(spark, EXPERIMENTS), OUTCOMES)
    return rounded(out.select("experiment", "outcome", "n_obs", "att", "att_se", "att_p", "parallel_trends_p", "significant"),
                   {"att": 4, "att_se": 4, "att_p": 6, "parallel_trends_p": 6})


# Unit-level rows: one observation per order, reduced to (arm, date) moments before anything else.
ORDER_ROWS = f"""panel AS (SELECT r_name AS route, CAST(o_orderdate AS DATE) AS date, o_totalprice AS yield_aud, 1 AS pax
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


ORDER_SQL = f"""WITH {ORDER_ROWS}, {did_rows_sql(E1)}, {did_fit_sql('d', 'po', 'f')}
    SELECT outcome, n_obs, round(att, 2) AS att, round(att_se, 2) AS att_se FROM f WHERE outcome = 'yield_aud'"""


def _order_rows(spark, sf, orders, *more):
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    owners = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("r_name").alias("route"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("yield_aud"), *more)


def _order_out(fitted):
    return rounded(fitted.select("outcome", "n_obs", "att", "att_se"), {"att": 2, "att_se": 2})


@query("j02_did_order_level", ORDER_SQL)
def _order_level(spark, sf):
    rows = _order_rows(spark, sf, table(spark, sf, "orders"))
    return _order_out(did.fit_tests(did.moments(rows, _specs(spark), ["yield_aud"])))


@query("m01_incremental_did", ORDER_SQL)
def _incremental(spark, sf):
    folder = shared_folder(spark)
    arriving = spark.readStream.schema(TABLE_SCHEMAS["orders"]).parquet(f"{sf}/orders.parquet*")
    running = did_updates.maintain(_order_rows(spark, sf, arriving), _specs(spark), ["yield_aud"], folder)
    running.awaitTermination()
    return _order_out(did_updates.estimates(spark, folder))


@query("m01_stateful_did", ORDER_SQL)
def _stateful(spark, sf):
    """Orders dealt by quarter into files that arrive one by one, some of them twice; the state forgets what the watermark passes."""
    folder = shared_folder(spark)
    orders = table(spark, sf, "orders")
    quarter = F.date_format(F.date_trunc("quarter", F.col("o_orderdate")), "yyyy-MM")
    again = orders.filter(F.col("o_orderkey") % 97 == 0)
    orders.unionByName(again).withColumn("quarter", quarter).repartition("quarter").sortWithinPartitions("quarter").write.partitionBy("quarter").parquet(f"{folder}/in")
    files = spark.readStream.schema(TABLE_SCHEMAS["orders"] + ", quarter string").option("maxFilesPerTrigger", 8).parquet(f"{folder}/in")
    running = panel_state.keep(_order_rows(spark, sf, files, "o_orderkey"), ["yield_aud"], folder, "4000 days", ["o_orderkey"])
    running.awaitTermination()
    panel_state.compact(spark, folder)
    return _order_out(panel_state.estimates(spark, folder, _specs(spark)))


# The first experiment's arms, with every fourth Monday as the date of the event.
ROLL_WEEKS, ROLL_PRE, ROLL_POST = 4, 52, 26
_ARMS = [f"[{', '.join(repr(r) for r in routes)}]" for routes in E1[0][2:4]]
_ROLLING_ROWS = did_rows_sql(E1)
ROLLING = f"""WITH {ORDER_ROWS}, span AS (SELECT min(date) + {7 * ROLL_PRE} AS low, max(date) - {7 * ROLL_POST} AS high FROM panel
      WHERE list_contains({_ARMS[0]}, route) OR list_contains({_ARMS[1]}, route)),
    specs AS (SELECT strftime(d, '%Y-%m-%d') AS experiment, CAST(d AS DATE) AS treatment_date, {_ARMS[0]} AS treatment_routes,
      {_ARMS[1]} AS control_routes, {ROLL_PRE} AS pre_weeks, {ROLL_POST} AS post_weeks
      FROM span, generate_series(TIMESTAMP '1970-01-05', TIMESTAMP '2100-01-01', INTERVAL {7 * ROLL_WEEKS} DAY) g(d) WHERE d BETWEEN low AND high),
    {_ROLLING_ROWS[_ROLLING_ROWS.index("d0 AS"):]}, {did_fit_sql('d', 'po', 'f')}, r AS (SELECT * FROM f WHERE outcome = 'yield_aud')"""


def _rolled(spark, sf):
    folder = shared_folder(spark)
    arriving = spark.readStream.schema(TABLE_SCHEMAS["orders"]).parquet(f"{sf}/orders.parquet*")
    panel_state.keep(_order_rows(spark, sf, arriving), ["yield_aud"], folder, "4000 days").awaitTermination()
    return panel_state.rolling(spark, folder, _specs(spark), ROLL_PRE, ROLL_POST, ROLL_WEEKS)


@query("m02_rolling_did", ROLLING + "SELECT experiment AS treatment_date, n_obs, round(att, 2) AS att, round(att_se, 2) AS att_se, round(att / att_se, 4) AS att_t FROM r")
def _rolling(spark, sf):
    out = _rolled(spark, sf).select("treatment_date", "n_obs", "att", "att_se", "att_t")
    return rounded(out, {"att": 2, "att_se": 2, "att_t": 4})


@query("m02_rolling_events", ROLLING + """, s AS (SELECT experiment, strptime(experiment, '%Y-%m-%d') AS day, abs(att / att_se) AS size FROM r)
    SELECT experiment AS treatment_date, round(size, 4) AS size FROM s WHERE size >= 0.5 AND size >= (SELECT max(size) FROM s o WHERE o.day BETWEEN s.day - INTERVAL 182 DAY AND s.day + INTERVAL 182 DAY)""")
def _events(spark, sf):
    found = did_rolling.events(_rolled(spark, sf), 0.5, 26)
    return rounded(found.select("treatment_date", F.abs("att_t").alias("size")), {"size": 4})


# Regression --------------------------------------------------------------------------------------------------------

LOGS = """logs AS (SELECT *, ln(pax) AS ln_pax, ln(yield_aud) AS ln_yield, ln(fuel_index) AS ln_fuel FROM {src} WHERE pax > 0)"""
SIN_COS = "sin(2 * pi() * week_of_year / 52) AS week_sin, cos(2 * pi() * week_of_year / 52) AS week_cos"
START = "1999-06-07"
RECENT = f"""{ENRICHED}, recent AS (SELECT *, {SIN_COS} FROM enriched WHERE date >= DATE '{START}'),
    {LOGS.format(src='recent')}"""


def _recent(spark, sf):
    return enriched(spark, sf, start=START)


_VARS = ["ln_yield", "ln_fuel", "business_mix", "ln_pax"]


@query("d14_moments", f"WITH {PANEL}, {LOGS.format(src='panel')} " + " UNION ALL ".join(
    f"SELECT route, '{a}' AS var_a, '{b}' AS var_b, count(*) AS n, round(covar_pop({a}, {b}), 8) AS covariance FROM logs GROUP BY route"
    for i, a in enumerate(_VARS) for b in _VARS[i:]))
def _moments(spark, sf):
    logs = elasticity.log_columns(panel(spark, sf))
    rows = regression.moment_rows(logs, _VARS, ["route"])
    return rounded(rows, {"covariance": 8})


@query("j01_simple_ols", f"""WITH {PANEL}, {LOGS.format(src='panel')} SELECT route, regr_count(ln_pax, ln_yield) AS n,
    round(regr_slope(ln_pax, ln_yield), 6) AS slope, round(regr_intercept(ln_pax, ln_yield), 6) AS intercept,
    round(sqrt((regr_syy(ln_pax, ln_yield) - regr_slope(ln_pax, ln_yield) * regr_sxy(ln_pax, ln_yield))
      / (count(*) - 2) / regr_sxx(ln_pax, ln_yield)), 6) AS slope_se, round(regr_r2(ln_pax, ln_yield), 6) AS r2
    FROM logs GROUP BY route""")
def _simple(spark, sf):
    logs = elasticity.log_columns(panel(spark, sf))
    out = logs.groupBy("route").agg(*regression.simple_ols(F.col("ln_pax"), F.col("ln_yield")))
    return rounded(out.withColumn("n", F.col("n").cast("long")), {"slope": 6, "intercept": 6, "slope_se": 6, "r2": 6})


_XS = ["ln_yield", "business_mix", "week_sin", "week_cos", "covid_factor"]


def _ols_sql():
    k = len(_XS) + 1
    rows = " UNION ALL ".join(
        f"""SELECT route, n, round(1 - sse / sst, 6) AS r2, '{x}' AS term, round(b{i}, 6) AS estimate,
        round(sqrt(sse / (n - {k}) * i{i} / n), 6) AS se,
        CASE WHEN i{i} > 0 THEN round({t_tail_sql(f'b{i} / sqrt(sse / (n - {k}) * i{i} / n)', f'n - {k}')}, 6) END AS p
        FROM s_fit""" for i, x in enumerate(_XS))
    return f"WITH {RECENT}, {sweep('s', 'logs', ['route'], _XS, 'ln_pax')} {rows}"


@query("j01_grouped_ols", _ols_sql())
def _grouped(spark, sf):
    out = regression.ols(elasticity.log_columns(_recent(spark, sf)), "ln_pax", _XS, ["route"])
    slopes = out.filter(F.col("term") != "intercept").withColumn("p", F.nanvl("p", F.lit(None).cast("double")))
    return rounded(slopes.select("route", "n", "r2", "term", "estimate", "se", "p"), {"r2": 6, "estimate": 6, "se": 6, "p": 6})


def _elasticity_ctes(source: str, controls: list[str], recent: str = RECENT) -> str:
    """OLS by sweep; first stage by sweep, then fitted prices row by row and a second sweep on them."""
    fitted = "t.m{y} + t.b0 * (l.ln_fuel - t.m0)".format(y=len(controls) + 1)
    fitted += "".join(f" + t.b{i + 1} * (l.{c} - t.m{i + 1})" for i, c in enumerate(controls))
    k = len(controls) + 2
    return f"""{recent},
  {sweep('o', source, ['route'], ['ln_yield', *controls], 'ln_pax')},
  {sweep('t', source, ['route'], ['ln_fuel', *controls], 'ln_yield')},
  hat AS (SELECT l.*, {fitted} AS ln_hat FROM {source} l JOIN t_fit t ON l.route = t.route),
  {sweep('v', 'hat', ['route'], ['ln_hat', *controls], 'ln_pax')},
  actual AS (SELECT l.route, sum(power(l.ln_pax - v.m{k - 1} - v.b0 * (l.ln_yield - v.m0)
      {''.join(f' - v.b{i + 1} * (l.{c} - v.m{i + 1})' for i, c in enumerate(controls))}, 2)) AS true_sse
    FROM {source} l JOIN v_fit v ON l.route = v.route GROUP BY l.route),
  est AS (SELECT o.route, o.n, o.b0 AS ols, sqrt(o.sse / (o.n - {k}) * o.i0 / o.n) AS ols_se, 1 - o.sse / o.sst AS r2,
      v.b0 AS iv, sqrt(v.sse / (o.n - {k}) * v.i0 / o.n) AS iv_se, (t.sst - t.sse) / (t.sse / (o.n - {k})) AS f1,
      t.b0 * t.b0 / (t.sse / (o.n - {k}) * t.i0 / o.n) AS partial_f,
      sqrt(a.true_sse / (o.n - {k}) * v.i0 / o.n) AS iv_se_corrected, o.n - {k} AS dof
    FROM o_fit o JOIN t_fit t ON o.route = t.route JOIN v_fit v ON o.route = v.route JOIN actual a ON a.route = o.route),
  tested AS (SELECT *, power(ols - iv, 2) / abs(iv_se * iv_se - ols_se * ols_se + 1e-10) AS h FROM est)"""


_FULL = _elasticity_ctes("logs", fv.ELASTICITY_CONTROLS)


@query("j08_ols_elasticity", f"""WITH {_FULL} SELECT route, n, round_even(ols, 4) AS ols_elasticity, round_even(ols_se, 4) AS ols_se,
    round_even(ols / ols_se, 3) AS ols_t, round_even(r2, 4) AS ols_r2 FROM tested""")
def _ols(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "n", "ols_elasticity", "ols_se", "ols_t", "ols_r2")


def _robust_sql() -> str:
    """J8's design again, each slope with the robust error of its regressor's own part: what the other regressors leave of it. A regressor
    without a part of its own has estimate and error zero."""
    xs = ["ln_yield", *fv.ELASTICITY_CONTROLS]
    k = len(xs) + 1
    out, last = [], []
    for i, x in enumerate(xs):
        others = [o for o in xs if o != x]
        out.append(sweep(f"p{i}", "logs", ["route"], others, x))
        part = f"l.{x} - q.m{len(others)}" + "".join(f" - q.b{j} * (l.{o} - q.m{j})" for j, o in enumerate(others))
        left = f"l.ln_pax - o.m{len(xs)}" + "".join(f" - o.b{j} * (l.{o} - o.m{j})" for j, o in enumerate(xs))
        last.append(f"""SELECT l.route, '{x}' AS term, o.n, round(any_value(o.b{i}), 6) AS estimate,
            CASE WHEN sum(power({part}, 2)) > 1e-18 THEN round(sqrt(sum(power({part}, 2) * power({left}, 2)) * o.n / (o.n - {k}))
              / sum(power({part}, 2)), 6) ELSE 0 END AS se_hc1
            FROM logs l JOIN o_fit o ON l.route = o.route JOIN p{i}_fit q ON l.route = q.route GROUP BY l.route, o.n""")
    return f"WITH {RECENT}, {sweep('o', 'logs', ['route'], xs, 'ln_pax')}, {', '.join(out)} {' UNION ALL '.join(last)}"


@query("j06_general", _robust_sql())
def _robust(spark, sf):
    xs = ["ln_yield", *fv.ELASTICITY_CONTROLS]
    out = regression.robust_ols(elasticity.log_columns(_recent(spark, sf)), "ln_pax", xs, ["route"]).filter(F.col("term") != "intercept")
    return rounded(out.select("route", "term", "n", "estimate", "se_hc1"), {"estimate": 6, "se_hc1": 6})


@query("j09_two_stage", f"""WITH {_FULL} SELECT route, round_even(iv, 4) AS iv_elasticity, round_even(iv_se, 4) AS iv_se,
    round_even(iv / iv_se, 3) AS iv_t FROM tested""")
def _iv(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "iv_elasticity", "iv_se", "iv_t")


@query("j10_stage1_f", f"""WITH {_FULL} SELECT route, round_even(f1, 2) AS stage1_fstat, round_even(partial_f, 2) AS stage1_partial_f
    FROM tested""")
def _stage1(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "stage1_fstat", "stage1_partial_f")


@query("j11_hausman", f"""WITH {_FULL} SELECT route, round_even(h, 4) AS hausman_stat,
    round_even({chi2_tail_sql('h')}, 4) AS hausman_p FROM tested""")
def _hausman(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "hausman_stat", "hausman_p")


@query("j12_preferred", f"""WITH {_FULL} SELECT route, {chi2_tail_sql('h')} < 0.05 AS endogenous,
    round_even(CASE WHEN {chi2_tail_sql('h')} < 0.05 THEN iv ELSE ols END, 4) AS preferred_elasticity FROM tested""")
def _preferred(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "endogenous", "preferred_elasticity")


@query("j13_corrected_iv_error", f"WITH {_FULL} SELECT route, round_even(iv_se_corrected, 4) AS iv_se_corrected FROM tested")
def _corrected(spark, sf):
    return elasticity.estimate(_recent(spark, sf)).select("route", "iv_se_corrected")


def _table_sql(ctes: str) -> str:
    return f"""WITH {ctes} SELECT route, n, round_even(ols, 4) AS ols_elasticity, round_even(ols_se, 4) AS ols_se,
    round_even(ols / ols_se, 3) AS ols_t, round_even({t_tail_sql('ols / ols_se', 'dof')}, 4) AS ols_p,
    round_even(r2, 4) AS ols_r2, round_even(iv, 4) AS iv_elasticity, round_even(iv_se, 4) AS iv_se,
    round_even(iv / iv_se, 3) AS iv_t, round_even({t_tail_sql('iv / iv_se', 'dof')}, 4) AS iv_p,
    round_even(f1, 2) AS stage1_fstat, round_even(h, 4) AS hausman_stat, round_even({chi2_tail_sql('h')}, 4) AS hausman_p,
    {chi2_tail_sql('h')} < 0.05 AS endogenous,
    round_even(CASE WHEN {chi2_tail_sql('h')} < 0.05 THEN iv ELSE ols END, 4) AS preferred_elasticity
    FROM tested WHERE n >= {fv.ELASTICITY_MIN_OBS}"""


@query("j14_elasticity_table", _table_sql(_FULL))
def elasticity_table(spark, sf):
    return stages.elasticity_table(_recent(spark, sf), START)


_BRAND_RECENT = f"""{panel_sql("n_name || '|' || p_brand", "JOIN part ON l_partkey = p_partkey")},
    recent AS (SELECT *, {SIN_COS} FROM panel), {LOGS.format(src='recent')}"""


@query("j14_elasticity_many_routes",
       _table_sql(_elasticity_ctes("logs", ["competition_index", "week_sin", "week_cos"], _BRAND_RECENT)))
def _many_routes(spark, sf):
    return stages.elasticity_table(panel(spark, sf, grain="nation_brand"), None)


# Tail probabilities ------------------------------------------------------------------------------------------------

@query("g11_student_t", f"""WITH {PANEL}, {LOGS.format(src='panel')}, c AS (SELECT route, year, corr(ln_pax, ln_yield) AS r,
      count(*) AS n FROM logs GROUP BY route, year HAVING count(*) > 5),
    s AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c)
    SELECT route, year, round(t, 6) AS t, round({t_tail_sql('t', 'n - 2')}, 8) AS p FROM s""")
def _student(spark, sf):
    logs = elasticity.log_columns(panel(spark, sf))
    c = logs.groupBy("route", "year").agg(F.corr("ln_pax", "ln_yield").alias("r"), F.count(F.lit(1)).alias("n"))
    s = c.filter(F.col("n") > 5).withColumn("t", F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r"))))
    p = student_t_p(F.col("t"), (F.col("n") - 2).cast("double"))
    return rounded(s.select("route", "year", "t", p.alias("p")), {"t": 6, "p": 8})


@query("g12_chi_square", f"""WITH {PANEL}, c AS (SELECT route, year, power(avg(load_factor) - 0.5, 2) * 1e4 AS x FROM panel
    GROUP BY route, year) SELECT route, year, round(x, 6) AS x, round({chi2_tail_sql('x')}, 8) AS p FROM c""")
def _chi(spark, sf):
    x = F.pow(F.avg("load_factor") - 0.5, F.lit(2.0)) * 1e4
    c = panel(spark, sf).groupBy("route", "year").agg(x.alias("x"))
    return rounded(c.withColumn("p", chi2_1_p("x")), {"x": 6, "p": 8})


P_SQL = f"CASE WHEN {{t}} <= {fv.UNIT_ROOT_SEGMENTS[0][0]} THEN {fv.UNIT_ROOT_P_LOW} " + " ".join(
    f"WHEN {{t}} <= {b} THEN {p}::DOUBLE + ({{t}} - ({a}::DOUBLE)) * ({q}::DOUBLE - {p}::DOUBLE) / ({b}::DOUBLE - ({a}::DOUBLE))"
    for a, b, p, q in fv.UNIT_ROOT_SEGMENTS) + f" ELSE {fv.UNIT_ROOT_P_HIGH} END"


@query("g13_unit_root_p", f"""SELECT o_orderkey, tau, round(greatest(0.001, least(0.999, {P_SQL.format(t='tau')})), 8) AS p
    FROM (SELECT o_orderkey, (o_orderkey % 97) / 16.0::DOUBLE - 5 AS tau FROM orders)""")
def _root_p(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 97 / F.lit(16.0) - 5).alias("tau"))
    return rounded(t.withColumn("p", unit_root_p(F.col("tau"))), {"p": 8})


# Unit roots --------------------------------------------------------------------------------------------------------

def _adf_sql(lags: int, source: str = "panel") -> str:
    lagged = "".join(f", lag(dy, {i}) OVER (PARTITION BY route ORDER BY date) AS dy_lag{i}" for i in range(1, lags + 1))
    xs = ["y_prev", *[f"dy_lag{i}" for i in range(1, lags + 1)]]
    last = xs[-1] if lags else "dy"
    return f"""{source}, d1 AS (SELECT route, date, CAST(pax AS DOUBLE) - lag(pax, 1) OVER (PARTITION BY route ORDER BY date) AS dy,
      CAST(lag(pax, 1) OVER (PARTITION BY route ORDER BY date) AS DOUBLE) AS y_prev FROM panel),
    d2 AS (SELECT *{lagged} FROM d1), d3 AS (SELECT * FROM d2 WHERE {last} IS NOT NULL),
    {sweep('w', 'd3', ['route'], xs, 'dy')},
    tau AS (SELECT route, n AS n_obs, b0 / sqrt(sse / (n - {lags + 2}) * i0 / n) AS t FROM w_fit)"""


def _adf_select(lags) -> str:
    p = f"greatest(0.001, least(0.999, {P_SQL.format(t='t')}))"
    return f"""SELECT route, {lags} AS n_lags, CAST(n_obs AS INTEGER) AS n_obs, round(t, 6) AS adf_t_stat,
    round({p}, 6) AS adf_p, {p} < 0.05 AS is_stationary FROM tau"""


def _adf_out(df):
    return rounded(df.select("route", "n_lags", "n_obs", "adf_t_stat", "adf_p", "is_stationary"), {"adf_t_stat": 6, "adf_p": 6})


@query("h06_adf_lag4", f"WITH {_adf_sql(4, PANEL)} {_adf_select(4)}")
def _adf4(spark, sf):
    return _adf_out(unitroot.adf(panel(spark, sf), max_lag=4))


MOST_LAGS = 17  # enough for series of up to 500 periods
_LAGS = [f"dy_lag{i}" for i in range(1, MOST_LAGS + 1)]
SCHWERT = f"""{PANEL}, d1 AS (SELECT route, date, CAST(pax AS DOUBLE) - lag(pax, 1) OVER w AS dy, CAST(lag(pax, 1) OVER w AS DOUBLE) AS y_prev,
      row_number() OVER w AS pos, count(*) OVER (PARTITION BY route) AS len FROM panel WINDOW w AS (PARTITION BY route ORDER BY date)),
    d2 AS (SELECT *, least(CAST(floor(12 * power(len / 100.0::DOUBLE, 0.25)) AS INTEGER), len // 4) AS k FROM d1),
    d3 AS (SELECT *, {', '.join(f'CASE WHEN {i} <= k THEN lag(dy, {i}) OVER (PARTITION BY route ORDER BY date) ELSE 0 END AS dy_lag{i}'
                                for i in range(1, MOST_LAGS + 1))} FROM d2),
    d4 AS (SELECT * FROM d3 WHERE pos >= k + 2),
    {sweep('w', 'd4', ['route', 'k'], ['y_prev', *_LAGS], 'dy')},
    tau AS (SELECT route, k, n AS n_obs, b0 / sqrt(sse / (n - (k + 2)) * i0 / n) AS t FROM w_fit)"""


@query("h06_adf", f"WITH {SCHWERT} {_adf_select('CAST(k AS INTEGER)')}")
def _adf(spark, sf):
    return _adf_out(unitroot.adf(panel(spark, sf)))


@query("h06_adf_k0", f"""WITH {_adf_sql(0, PANEL)} SELECT route, n_obs, round(t, 6) AS adf_t_stat FROM tau""")
def _adf0(spark, sf):
    out = unitroot.adf_without_lags(panel(spark, sf))
    return rounded(out.select("route", F.col("n_obs").cast("long").alias("n_obs"), "adf_t_stat"), {"adf_t_stat": 6})


@query("h07_stationarity_verdict", f"""WITH {_adf_sql(0, PANEL)} SELECT route,
    greatest(0.001, least(0.999, {P_SQL.format(t='t')})) < 0.05 AS is_stationary, -2.8621::DOUBLE AS critical_5 FROM tau""")
def _verdict(spark, sf):
    return unitroot.adf_without_lags(panel(spark, sf)).select("route", "is_stationary", "critical_5")


@query("i12_forecast_stage", f"""WITH RECURSIVE {TRAINED}, {SCHWERT[len(PANEL) + 2:]},
    hm AS (SELECT route, count(*) FILTER (period = 'train') AS n_train, count(*) FILTER (period = 'test') AS n_test,
      avg(abs((actual - hw_fc) / actual)) FILTER (period = 'test') AS hw_mape FROM hw GROUP BY route),
    adf AS ({_adf_select('CAST(k AS INTEGER)')})
    SELECT hm.route, n_train, n_test, round_even(hw_mape, 4) AS hw_mape, alpha AS hw_alpha, beta AS hw_beta, gamma AS hw_gamma,
      round_even(adf.adf_t_stat, 4) AS adf_t_stat, round_even(adf.adf_p, 4) AS adf_p, adf.is_stationary
    FROM hm JOIN won ON won.route = hm.route LEFT JOIN adf ON adf.route = hm.route""")
def forecast_stage(spark, sf):
    m = stages.forecast(enriched(spark, sf), base_year=BASE_YEAR)["model_metrics"]
    return m.select("route", "n_train", "n_test", "hw_mape", "hw_alpha", "hw_beta", "hw_gamma", "adf_t_stat", "adf_p", "is_stationary")


@query("i07_metrics_table", f"""WITH RECURSIVE {CHAIN}, {SCHWERT[len(PANEL) + 2:]}, {FOLD_ROWS}, m AS ({METRICS_SQL}),
    c AS (SELECT route, fold, avg(abs((actual - hybrid_fc) / actual)) AS mape FROM folds WHERE role = 'val' GROUP BY 1, 2),
    cv AS (SELECT route, avg(mape) AS cv_mape_mean, stddev_pop(mape) AS cv_mape_std FROM c GROUP BY route),
    adf AS ({_adf_select('CAST(k AS INTEGER)')})
    SELECT m.route, n_train, n_test, round_even(hw_mape, 4) AS hw_mape, round_even(hybrid_mape, 4) AS hybrid_mape, round_even(hybrid_rmse, 2) AS hybrid_rmse,
      round_even(hybrid_r2, 4) AS hybrid_r2, round_even((hw_mape - hybrid_mape) / hw_mape * 100, 2) AS mape_improvement_pct,
      round_even(cv_mape_mean, 4) AS cv_mape_mean, round_even(cv_mape_std, 4) AS cv_mape_std, alpha AS hw_alpha, beta AS hw_beta, gamma AS hw_gamma,
      round_even(adf.adf_t_stat, 4) AS adf_t_stat, round_even(adf.adf_p, 4) AS adf_p, adf.is_stationary
    FROM m JOIN cv ON cv.route = m.route JOIN won ON won.route = m.route LEFT JOIN adf ON adf.route = m.route""")
def metrics_table(spark, sf):
    p = cut_lineage(panel(spark, sf))
    t = cut_lineage(chain_table(p))
    val = filters.walk_forward(t.filter(F.col("period") == "train"), fv.CV_FOLDS, fv.CV_FOLD_WEEKS).filter(F.col("role") == "val")
    cv = hybrid.cv_summary(val.groupBy("route", "fold").agg(metrics.mape(F.col("actual"), F.col("hybrid_fc")).alias("mape")))
    params = t.groupBy("route").agg(*[F.first(c).alias(f"hw_{c}") for c in ("alpha", "beta", "gamma")])
    adf = unitroot.adf(p).select("route", "adf_t_stat", "adf_p", "is_stationary")
    return metrics.round_metrics(metrics.forecast_metrics(t).join(cv, "route").join(params, "route").join(adf, "route", "left"))
