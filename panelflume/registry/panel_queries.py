"""Queries on sources, selection, enrichment, aggregates, features and functions."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from panelflume import fixed_values as fv
from panelflume.functions import columns as fx
from panelflume.operators import enrich, features, filters, gaps, intervals, metrics
from panelflume.registry.base import (BASE_YEAR, CPI, DAY, ENRICHED, EVENT_SUM, FEATURES, LOOKUPS, ORDER_JOINS, PANEL,
                                      REGIME, demo, demo_tables, enriched, feature_frame, features_sql, iso, panel_sql,
                                      query, rounded, with_sql)
from panelflume.sources import PANEL_SCHEMA, files, panel, table

PANEL_COLS = ("route, {d}, pax, revenue, yield_aud, load_factor, competition_index, fuel_index, business_mix, "
              "week_of_year, year, month, quarter").format(d=DAY)
P = f"WITH {PANEL} "
E_ = f"WITH {ENRICHED} "


# Sources and sinks -------------------------------------------------------------------------------------------------

@query("a01_csv_round_trip", P + f"SELECT {PANEL_COLS} FROM panel")
def _csv(spark, sf):
    folder = files.shared_folder(spark)
    files.write_csv(panel(spark, sf), f"{folder}/panel")
    return iso(files.read_csv(spark, f"{folder}/panel", PANEL_SCHEMA))


@query("a02_csv_sink", P + """SELECT route, year, CAST(sum(pax) AS BIGINT) AS pax, strftime(max(date), '%Y-%m-%d') AS last_week
    FROM panel GROUP BY route, year""")
def _csv_sink(spark, sf):
    folder = files.shared_folder(spark)
    annual = panel(spark, sf).groupBy("route", "year").agg(F.sum("pax").alias("pax"), F.max("date").alias("last_week"))
    files.write_csv(annual, f"{folder}/tables/annual")
    return iso(files.read_csv(spark, f"{folder}/tables/annual", annual.schema))


@query("a03_json_round_trip", P + """SELECT route, year, CAST(sum(pax) AS BIGINT) AS pax, count(*) AS weeks
    FROM panel GROUP BY route, year""")
def _json(spark, sf):
    folder = files.shared_folder(spark)
    annual = panel(spark, sf).groupBy("route", "year").agg(F.sum("pax").alias("pax"), F.count(F.lit(1)).alias("weeks"))
    files.write_json(annual.select("route", F.struct("year", "pax", "weeks").alias("totals")), f"{folder}/totals")
    back = files.read_json(spark, f"{folder}/totals", "route string, totals struct<year:int,pax:bigint,weeks:bigint>")
    return back.select("route", "totals.*")


@query("a05_optional_scan", P + "SELECT route, CAST(sum(pax) AS BIGINT) AS pax, 0.58::DOUBLE AS share FROM panel GROUP BY route")
def _optional(spark, sf):
    overrides = files.read_optional(spark, f"{sf}/route_overrides.parquet", "route string, share double")
    totals = panel(spark, sf).groupBy("route").agg(F.sum("pax").alias("pax"))
    return totals.join(overrides, "route", "left").withColumn("share", F.coalesce("share", F.lit(fv.MARKET_SHARE)))


@query("a05_optional_present", P + """SELECT p.route, CAST(sum(pax) AS BIGINT) AS pax, 0.5::DOUBLE + any_value(r_regionkey) / 100.0::DOUBLE AS share
    FROM panel p JOIN region ON r_name = p.route GROUP BY p.route""")
def _optional_present(spark, sf):
    folder = files.shared_folder(spark)
    shares = table(spark, sf, "region").select(F.col("r_name").alias("route"), (F.lit(0.5) + F.col("r_regionkey") / F.lit(100.0)).alias("share"))
    shares.write.parquet(f"{folder}/route_overrides.parquet")
    overrides = files.read_optional(spark, f"{folder}/route_overrides.parquet", "route string, share double")
    totals = panel(spark, sf).groupBy("route").agg(F.sum("pax").alias("pax"))
    return totals.join(overrides, "route", "left").withColumn("share", F.coalesce("share", F.lit(fv.MARKET_SHARE)))


@query("a06_json_arrays", P + """, y AS (SELECT route, year, CAST(sum(pax) AS BIGINT) AS pax FROM panel WHERE route < 'B' GROUP BY 1, 2)
    SELECT r_name AS route, coalesce(to_json(list(struct_pack(year := year, pax := pax) ORDER BY year) FILTER (year IS NOT NULL))::VARCHAR, '[]') AS records
    FROM region LEFT JOIN y ON y.route = r_name GROUP BY r_name""")
def _arrays(spark, sf):
    annual = panel(spark, sf).filter("route < 'B'").groupBy("route", "year").agg(F.sum("pax").alias("pax"))
    return files.json_arrays(annual, table(spark, sf, "region").select(F.col("r_name").alias("route")), "route", "year")


@query("a06_json_records", P + """SELECT to_json(struct_pack(route := route, year := year, pax := CAST(sum(pax) AS BIGINT)))::VARCHAR
    AS record FROM panel GROUP BY route, year""")
def _records(spark, sf):
    annual = panel(spark, sf).groupBy("route", "year").agg(F.sum("pax").alias("pax"))
    return annual.select(F.to_json(F.struct("route", "year", "pax")).alias("record"))


@query("a07_panel_scan", P + f"SELECT {PANEL_COLS} FROM panel")
def _panel(spark, sf):
    return iso(panel(spark, sf))


@query("a07_panel_scan_nation_brand", "WITH " + panel_sql(
    "n_name || '|' || p_brand", "JOIN part ON l_partkey = p_partkey") + f" SELECT {PANEL_COLS} FROM panel")
def _panel_fine(spark, sf):
    return iso(panel(spark, sf, grain="nation_brand"))


@query("a08_result_export", P + """SELECT route, strftime(date_trunc('month', date), '%Y-%m-%d') AS month_start,
    CAST(sum(pax) AS BIGINT) AS pax FROM panel GROUP BY 1, 2""")
def _export(spark, sf):
    folder = files.shared_folder(spark)
    files.write_results({"forecasts": metrics.monthly(panel(spark, sf)).drop("revenue")}, folder)
    back = spark.read.schema("month_start date, pax bigint, route string").parquet(f"{folder}/forecasts")
    return iso(back)


@query("a08_committed_export", P + """SELECT route, strftime(date_trunc('month', date), '%Y-%m-%d') AS month_start,
    CAST(sum(pax) + CASE WHEN route = 'ASIA' THEN 1000 ELSE 0 END AS BIGINT) AS pax FROM panel GROUP BY 1, 2""")
def _committed(spark, sf):
    folder = files.shared_folder(spark)
    monthly = metrics.monthly(panel(spark, sf)).select("route", "month_start", "pax")
    files.export({"monthly": monthly}, folder)
    files.export({"monthly": monthly.filter("route = 'ASIA'").withColumn("pax", F.col("pax") + 1000)}, folder, replace=True)
    return iso(files.read_export(spark, folder, "monthly"))


# Selection ---------------------------------------------------------------------------------------------------------

SHORT = f"SELECT route, {DAY}, pax, revenue FROM panel"


@query("b00_repeated_keys", """SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows FROM orders
    GROUP BY 1, 2 HAVING count(*) > 1""")
def _repeated(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return filters.repeated_keys(orders, "o_custkey", "month")


@query("b01_entity_filter", P + SHORT + " WHERE route = 'ASIA'")
def _entity(spark, sf):
    return iso(panel(spark, sf, entities=["ASIA"]).select("route", "date", "pax", "revenue"))


@query("b02_in_list_filter", P + SHORT + " WHERE route IN ('ASIA', 'EUROPE', 'AFRICA')")
def _in_list(spark, sf):
    return iso(panel(spark, sf, entities=["ASIA", "EUROPE", "AFRICA"]).select("route", "date", "pax", "revenue"))


@query("b03_date_window", P + SHORT + " WHERE date BETWEEN DATE '1998-07-06' - 364 AND DATE '1998-07-06' + 182")
def _window(spark, sf):
    p = panel(spark, sf, start="1997-07-07", end="1999-01-11")
    inside = filters.date_window(F.col("date"), F.lit("1998-07-06").cast("date"), 52, 26)
    return iso(p.filter(inside).select("route", "date", "pax", "revenue"))


@query("b04_start_date", P + SHORT + " WHERE date >= DATE '2000-01-03'")
def _start(spark, sf):
    return iso(panel(spark, sf, start="2000-01-03").select("route", "date", "pax", "revenue"))


SPLIT = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date) AS position,
    count(*) OVER (PARTITION BY route) AS n_rows FROM panel)"""


@query("b05_category_filter", f"WITH {PANEL}{SPLIT} SELECT route, {DAY}, pax FROM ranked WHERE position > n_rows - 26")
def _category(spark, sf):
    split = filters.holdout_split(panel(spark, sf), fv.TEST_WEEKS)
    return iso(split.filter(F.col("period") == "test").select("route", "date", "pax"))


@query("b06_positive_filter", P + f"SELECT route, {DAY}, round(ln(pax), 6) AS ln_pax FROM panel WHERE pax > 0")
def _positive(spark, sf):
    p = panel(spark, sf).filter(F.col("pax") > 0)
    return iso(p.select("route", "date", F.round(F.ln("pax"), 6).alias("ln_pax")))


@query("b07_null_drop", f"WITH {FEATURES} SELECT route, {DAY}, pax_lag52 FROM feat WHERE pax_lag52 IS NOT NULL")
def _null_drop(spark, sf):
    return iso(features.add_features(panel(spark, sf)).select("route", "date", "pax_lag52"))


@query("b08_min_observations", "WITH " + panel_sql("n_name || '|' || p_brand", "JOIN part ON l_partkey = p_partkey")
       + """ SELECT route, count(*) AS n, CAST(sum(pax) AS BIGINT) AS pax FROM panel GROUP BY route HAVING count(*) >= 60""")
def _min_obs(spark, sf):
    kept = filters.min_observations(panel(spark, sf, grain="nation_brand"), fv.ELASTICITY_MIN_OBS)
    return kept.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("pax").alias("pax"))


@query("b09_present_columns", P + f"SELECT route, {DAY}, competition_index, business_mix FROM panel")
def _present(spark, sf):
    p = panel(spark, sf)
    wanted = [c for c in fv.FEATURE_COLS if c.startswith(("comp", "bus", "covid", "rba"))]
    return iso(p.select("route", "date", *filters.present(p, wanted)))


@query("b10_dummies", P + f"""SELECT route, {DAY}, CAST(route IN ('ASIA', 'EUROPE') AS INTEGER) AS treated,
    CAST(date >= DATE '1998-07-06' AS INTEGER) AS post,
    CAST(route IN ('ASIA', 'EUROPE') AND date >= DATE '1998-07-06' AS INTEGER) AS did FROM panel""")
def _dummies(spark, sf):
    treated = F.col("route").isin("ASIA", "EUROPE").cast("int")
    post = (F.col("date") >= F.lit("1998-07-06").cast("date")).cast("int")
    return iso(panel(spark, sf).select("route", "date", treated.alias("treated"), post.alias("post"),
                                       (treated * post).alias("did")))


@query("b11_clip", P + f"""SELECT route, {DAY}, CASE WHEN l IS NOT NULL THEN greatest(-0.2, least(0.2, l)) END AS clipped
    FROM (SELECT *, round(pax / (lag(pax, 1) OVER (PARTITION BY route ORDER BY date) + 1.0::DOUBLE) - 1, 6) AS l FROM panel)""")
def _clip(spark, sf):
    change = F.round(fx.growth(F.col("pax"), F.lag("pax", 1).over(filters.series_window())), 6)
    return iso(panel(spark, sf).withColumn("l", change)
               .select("route", "date", fx.clip(F.col("l"), -0.2, 0.2).alias("clipped")))


@query("b12_integer_truncation", P + f"SELECT route, {DAY}, CAST(trunc(revenue) AS BIGINT) AS whole_revenue FROM panel")
def _whole(spark, sf):
    return iso(panel(spark, sf).select("route", "date", fx.whole(F.col("revenue")).alias("whole_revenue")))


@query("b13_half_even_rounding", P + f"""SELECT route, {DAY}, round_even(pax / 4.0::DOUBLE, 0) AS quarter_pax,
    round_even(pax / 8.0::DOUBLE, 2) AS eighth_pax FROM panel""")
def _half_even(spark, sf):
    return iso(panel(spark, sf).select(
        "route", "date", fx.half_even(F.col("pax") / F.lit(4.0)).alias("quarter_pax"),
        fx.half_even(F.col("pax") / F.lit(8.0), 2).alias("eighth_pax")))


@query("b14_holdout_split", f"""WITH {PANEL}{SPLIT} SELECT route, {DAY}, position, n_rows,
    CASE WHEN position > n_rows - 26 THEN 'test' ELSE 'train' END AS period FROM ranked""")
def _holdout(spark, sf):
    return iso(filters.holdout_split(panel(spark, sf), fv.TEST_WEEKS)
               .select("route", "date", F.col("position").cast("long"), "n_rows", "period"))


@query("b15_tail_slice", f"""WITH {PANEL}{SPLIT} SELECT route, {DAY}, pax FROM ranked WHERE position > n_rows - 104""")
def _tail(spark, sf):
    return iso(filters.tail(panel(spark, sf), 104).select("route", "date", "pax"))


@query("b16_distinct_entities", f"""SELECT DISTINCT n_name || '|' || p_brand AS route FROM {ORDER_JOINS}
    JOIN part ON l_partkey = p_partkey""")
def _distinct(spark, sf):
    return panel(spark, sf, grain="nation_brand").select("route").distinct().orderBy("route")


@query("b17_date_format", P + "SELECT route, strftime(date, '%Y-%m-%d') AS day_text FROM panel")
def _date_text(spark, sf):
    return panel(spark, sf).select("route", fx.iso_date(F.col("date")).alias("day_text"))


@query("b18_defaults", """SELECT o_orderkey, coalesce(nullif(CAST(o_orderkey % 3 AS DOUBLE) * 63, 0), 189) AS capacity,
    coalesce(nullif(CAST(o_custkey % 2 AS DOUBLE) * 0.5, 0), 0.85) AS lf_target FROM orders""")
def _defaults(spark, sf):
    d = fv.ALLOCATION_DEFAULTS
    return table(spark, sf, "orders").select(
        "o_orderkey", fx.or_default((F.col("o_orderkey") % 3).cast("double") * 63, d["capacity"]).alias("capacity"),
        fx.or_default((F.col("o_custkey") % 2).cast("double") * 0.5, d["lf_target"]).alias("lf_target"))


# Enrichment --------------------------------------------------------------------------------------------------------

@query("c01_macro_enrichment", E_ + f"SELECT route, {DAY}, rba_cash_rate, inflation, macro_fuel FROM enriched")
def _macro(spark, sf):
    return iso(enrich.macro(panel(spark, sf), demo(spark, "macro"))
               .select("route", "date", "rba_cash_rate", "inflation", "macro_fuel"))


@query("c02_entity_dimension", f"""WITH {PANEL}, {LOOKUPS} SELECT p.route, {DAY.replace('date,', 'p.date,')}, route_desc,
    base_pax_weekly, len(competitors) AS n_competitors, trend_pa FROM panel p LEFT JOIN routes r ON p.route = r.route""")
def _dimension(spark, sf):
    joined = enrich.entity_attributes(panel(spark, sf).drop("business_mix"), demo(spark, "routes"))
    return iso(joined.select("route", "date", "route_desc", "base_pax_weekly",
                             F.size("competitors").cast("long").alias("n_competitors"), "trend_pa"))


@query("c03_school_holiday", E_ + f"SELECT route, {DAY}, school_holiday FROM enriched")
def _school(spark, sf):
    return iso(enrich.school_holidays(panel(spark, sf), demo(spark, "school_holidays"))
               .select("route", "date", "school_holiday"))


@query("c04_public_holiday", E_ + f"SELECT route, {DAY}, public_holiday FROM enriched")
def _public(spark, sf):
    return iso(enrich.public_holidays(panel(spark, sf), demo(spark, "public_holidays"))
               .select("route", "date", "public_holiday"))


@query("c05_event_multiplier", f"""WITH {PANEL}, {LOOKUPS} SELECT route, {DAY},
    round(1 + coalesce({EVENT_SUM}, 0), 8) AS event_multiplier FROM panel p""")
def _events(spark, sf):
    return rounded(enrich.event_multiplier(panel(spark, sf), demo(spark, "events"))
                   .select("route", "date", "event_multiplier"), {"event_multiplier": 8})


@query("c06_regime_factor", f"""WITH {PANEL}, {LOOKUPS} SELECT route, {DAY}, round(coalesce({REGIME}, 1), 8) AS covid_factor
    FROM panel p""")
def _regime(spark, sf):
    return rounded(enrich.regime_factor(panel(spark, sf), demo(spark, "regimes"))
                   .select("route", "date", "covid_factor"), {"covid_factor": 8})


# Intervals by the microsecond, over the event table: each error opens an outage of `value` minutes, each purchase pulls for two
# hours around it, and the mean value moves on a line from one day to the next.
OUTAGES = """o AS (SELECT ts AS a, ts + to_microseconds(CAST(floor(value * 60000000) AS BIGINT)) AS b FROM events WHERE event_type = 'error')"""


def _event_table(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "value")


def _shifted(seconds):
    return F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.floor(seconds * 1_000_000).cast("long"))


@query("c03_interval_flag_at", f"""WITH {OUTAGES} SELECT event_id, CAST(EXISTS (SELECT 1 FROM o WHERE ts >= a AND ts < b) AS INTEGER) AS in_outage FROM events""")
def _outage(spark, sf):
    events = _event_table(spark, sf)
    outages = events.filter("event_type = 'error'").select(F.col("ts").cast("timestamp").alias("start"), _shifted(F.col("value") * 60).alias("end"))
    points = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return intervals.flagged(points, outages, "event_id", "ts", "in_outage").select("event_id", "in_outage")


@query("c05_effect_at", """WITH p AS (SELECT ts AS peak, value FROM events WHERE event_type = 'purchase'),
    m AS (SELECT event_id, sum(p.value * exp(-0.5 * power(date_diff('microsecond', peak, ts) / 2400000000.0::DOUBLE, 2))) AS pull FROM events
      JOIN p ON ts >= peak - INTERVAL 2 HOUR AND ts < peak + INTERVAL 2 HOUR GROUP BY event_id)
    SELECT e.event_id, round(coalesce(pull, 0), 5) AS pull FROM events e LEFT JOIN m ON m.event_id = e.event_id""")
def _pull(spark, sf):
    events = _event_table(spark, sf)
    peaks = events.filter("event_type = 'purchase'").select(F.col("ts").cast("timestamp").alias("peak"), "value", _shifted(F.lit(-7200.0)).alias("start"),
                                                            _shifted(F.lit(7200.0)).alias("end"))
    points = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))

    def effect(at):
        away = (F.unix_micros(at) - F.unix_micros("peak")) / F.lit(2400000000.0)
        return F.col("value") * F.exp(F.lit(-0.5) * away * away)

    out = intervals.summed(points, peaks, "event_id", "ts", effect, "pull", nodes=12)
    return out.select("event_id", F.round("pull", 5).alias("pull"))


@query("c06_regime_at", """WITH d AS (SELECT date_trunc('day', ts) AS a, avg(value) AS v0 FROM events GROUP BY 1),
    r AS (SELECT a, v0, lead(v0) OVER (ORDER BY a) AS v1, lead(a) OVER (ORDER BY a) AS b FROM d)
    SELECT event_id, round(coalesce(v0 + (v1 - v0) * (date_diff('microsecond', a, ts) / CAST(date_diff('microsecond', a, b) AS DOUBLE)), 1), 6) AS level
    FROM events LEFT JOIN r ON ts >= a AND ts < b""")
def _level(spark, sf):
    events = _event_table(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    days = events.groupBy(F.date_trunc("day", "ts").alias("start")).agg(F.avg("value").alias("v0"))
    nearest = Window.orderBy("start")
    regimes = days.withColumns({"v1": F.lead("v0").over(nearest), "end": F.lead("start").over(nearest)})
    return intervals.interpolated(events.select("event_id", "ts"), regimes, "event_id", "ts", "level").select("event_id", F.round("level", 6).alias("level"))


@query("c00_calendar_frame", E_ + f"""SELECT route, {DAY}, school_holiday, public_holiday, event_multiplier, covid_factor,
    rba_cash_rate, cpi_index FROM enriched""")
def _calendar(spark, sf):
    return iso(enriched(spark, sf).select("route", "date", "school_holiday", "public_holiday", "event_multiplier",
                                          "covid_factor", "rba_cash_rate", "cpi_index"))


@query("c11_competition_rules", f"""WITH {PANEL}, {LOOKUPS} SELECT p.route, strftime(p.date, '%Y-%m-%d') AS date,
    round(p.competition_index
      * CASE WHEN p.year = 1998 AND list_contains(r.competitors, 'RIVAL') THEN 0.65 ELSE 1 END
      * CASE WHEN p.year = 1998 AND list_contains(r.competitors, 'NEWCO') THEN 0.9 ELSE 1 END
      * CASE WHEN p.year = 1997 AND 1 - p.business_mix > 0.6 THEN 1.08 ELSE 1 END, 8) AS competition_index
    FROM panel p JOIN routes r ON p.route = r.route""")
def _rules(spark, sf):
    dim = demo(spark, "routes").select("route", "competitors")
    out = enrich.competition_rules(enrich.entity_attributes(panel(spark, sf), dim), demo(spark, "competition_rules"))
    return rounded(out.select("route", "date", "competition_index"), {"competition_index": 8})


# Aggregates --------------------------------------------------------------------------------------------------------

@query("d01_group_mean", P + "SELECT route, round(avg(yield_aud), 4) AS avg_yield FROM panel GROUP BY route")
def _group_mean(spark, sf):
    return panel(spark, sf).groupBy("route").agg(F.round(F.avg("yield_aud"), 4).alias("avg_yield"))


@query("d03_group_and_grand_total", P + """SELECT coalesce(route, 'ALL') AS route, CAST(sum(pax) AS BIGINT) AS pax,
    CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) AS revenue FROM panel GROUP BY ROLLUP (route)""")
def _totals(spark, sf):
    totals = panel(spark, sf).rollup("route").agg(F.sum("pax").alias("pax"), metrics.exact_sum("revenue").alias("revenue"))
    return totals.withColumn("route", F.coalesce("route", F.lit("ALL")))


@query("d12_monthly_rollup", P + """SELECT route, strftime(date_trunc('month', date), '%Y-%m-%d') AS month_start,
    CAST(sum(pax) AS BIGINT) AS pax, CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) AS revenue FROM panel GROUP BY 1, 2""")
def _monthly(spark, sf):
    return iso(metrics.monthly(panel(spark, sf)))


@query("d13_price_index", f"""WITH {PANEL}, {LOOKUPS} SELECT year, round({CPI}, 8) AS cpi_index
    FROM (SELECT DISTINCT year FROM panel) p""")
def _price_index(spark, sf):
    return rounded(enrich.price_index(panel(spark, sf).select("year"), demo(spark, "macro"), BASE_YEAR), {"cpi_index": 8})


# Features ----------------------------------------------------------------------------------------------------------

@query("e00_densify", "WITH " + panel_sql("n_name || '|' || p_brand", "JOIN part ON l_partkey = p_partkey") + """,
    spine AS (SELECT route, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
              FROM panel GROUP BY route)
    SELECT s.route, strftime(s.date, '%Y-%m-%d') AS date, coalesce(p.pax, 0) AS pax, coalesce(p.revenue, 0) AS revenue
    FROM spine s LEFT JOIN panel p ON s.route = p.route AND s.date = p.date""")
def _densify(spark, sf):
    p = panel(spark, sf, grain="nation_brand").select("route", "date", "pax", "revenue")
    return iso(enrich.densify(p, fill={"pax": 0, "revenue": 0.0}))


FILL_LIMIT = 4


@query("e00_fill", "WITH " + panel_sql("n_name || '|' || p_brand", "JOIN part ON l_partkey = p_partkey") + f""",
    spine AS (SELECT route, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date FROM panel GROUP BY route),
    dense AS (SELECT s.route, s.date, p.pax, row_number() OVER (PARTITION BY s.route ORDER BY s.date) AS n
      FROM spine s LEFT JOIN panel p ON s.route = p.route AND s.date = p.date),
    near AS (SELECT *, lag(pax, 52) OVER w AS before, last_value(CASE WHEN pax IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS np,
      first_value(CASE WHEN pax IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nf
      FROM dense WINDOW w AS (PARTITION BY route ORDER BY date))
    SELECT a.route, strftime(a.date, '%Y-%m-%d') AS date, CASE WHEN a.n - np <= {FILL_LIMIT} THEN b.pax END AS pax_forward,
      round(CASE WHEN a.pax IS NOT NULL THEN a.pax WHEN nf - np <= {FILL_LIMIT + 1} THEN b.pax + (c.pax - b.pax) * (a.n - np) / CAST(nf - np AS DOUBLE) END, 6) AS pax_linear,
      coalesce(a.pax, CASE WHEN a.n - np <= {FILL_LIMIT} THEN before END) AS pax_seasonal
    FROM near a LEFT JOIN dense b ON b.route = a.route AND b.n = np LEFT JOIN dense c ON c.route = a.route AND c.n = nf""")
def _fill(spark, sf):
    dense = enrich.densify(panel(spark, sf, grain="nation_brand").select("route", "date", "pax"))
    rows = dense.select("route", "date", F.col("pax").alias("pax_forward"), F.col("pax").cast("double").alias("pax_linear"), F.col("pax").alias("pax_seasonal"))
    out = gaps.fill(rows, {"pax_forward": "forward", "pax_linear": "linear", "pax_seasonal": "seasonal"}, FILL_LIMIT, bucket=F.year("date"), block_rows=104)
    return rounded(out, {"pax_linear": 6})


def _feature_query(name: str, cols: dict[str, int | None], leak_free: bool = False, block_rows: int | None = None,
                   drop_na: bool = False):
    sql_cols = ", ".join(c if d is None else f"round({c}, {d}) AS {c}" for c, d in cols.items())
    where = " WHERE pax_lag52 IS NOT NULL" if drop_na else ""

    @query(name, with_sql(features_sql(leak_free), f"SELECT route, {DAY}, {sql_cols} FROM feat{where}"))
    def run(spark, sf):
        frame = feature_frame(spark, sf, drop_na=drop_na, leak_free=leak_free, block_rows=block_rows)
        return rounded(frame.select("route", "date", *cols), {c: d for c, d in cols.items() if d is not None})


_feature_query("e01_pax_lags", {"pax_lag4": None, "pax_lag8": None, "pax_lag13": None, "pax_lag52": None})
_feature_query("e02_yield_lag", {"yield_lag4": None})
_feature_query("e03_yoy_growth", {"pax_yoy_growth": 8})
_feature_query("e04_rolling_mean", {"rolling_mean_4w": 6, "rolling_mean_13w": 6})
_feature_query("e05_rolling_std", {"rolling_std_4w": 4})
_feature_query("e06_pace", {"pax_vs_rolling": 8})
_feature_query("e07_cyclic_encoding", {"week_sin": 8, "week_cos": 8, "month_sin": 8, "month_cos": 8})
_feature_query("e08_season_flags", {"is_summer": None, "is_winter": None})
_feature_query("e09_year_index", {"year_idx": None})
_feature_query("e10_interactions", {"comp_x_biz": None, "rate_x_biz": None, "fuel_x_yield": None, "covid_x_school": None})

_ALL = {c: 6 for c in fv.FEATURE_COLS}
_ALL.update({c: None for c in ("is_summer", "is_winter", "year_idx", "school_holiday", "public_holiday", "pax_lag4",
                               "pax_lag8", "pax_lag13", "pax_lag52", "comp_x_biz", "rate_x_biz", "fuel_x_yield",
                               "covid_x_school", "competition_index", "business_mix", "fuel_index", "yield_lag4",
                               "rba_cash_rate", "cpi_index", "event_multiplier", "covid_factor")})
_ALL["rolling_std_4w"] = 4
_feature_query("e14_feature_frame", _ALL, drop_na=True)
_feature_query("e14_feature_frame_blocked", _ALL, drop_na=True, block_rows=64)
_feature_query("e15_leak_free_features", {"pax_yoy_growth": 8, "rolling_mean_4w": 6, "rolling_std_4w": 4,
                                          "rolling_mean_13w": 6, "pax_vs_rolling": 8}, leak_free=True)

DIFF = """, d1 AS (SELECT *, pax - lag(pax, 1) OVER (PARTITION BY route ORDER BY date) AS dy,
    lag(pax, 1) OVER (PARTITION BY route ORDER BY date) AS y_prev FROM panel)"""


@query("e11_first_difference", f"WITH {PANEL}{DIFF} SELECT route, {DAY}, dy FROM d1")
def _difference(spark, sf):
    return iso(features.differences(panel(spark, sf), 0).select("route", "date", "dy"))


@query("e12_lag_stack", f"""WITH {PANEL}{DIFF} SELECT route, {DAY}, y_prev, dy,
    {', '.join(f'lag(dy, {i}) OVER (PARTITION BY route ORDER BY date) AS dy_lag{i}' for i in range(1, 5))} FROM d1""")
def _lag_stack(spark, sf):
    return iso(features.differences(panel(spark, sf), 4).select(
        "route", "date", "y_prev", "dy", *[f"dy_lag{i}" for i in range(1, 5)]))


@query("e13_rank_in_group", P + """SELECT route, month, CAST(row_number() OVER (PARTITION BY route ORDER BY sum(pax) DESC, month)
    AS INTEGER) AS rank, CAST(sum(pax) AS BIGINT) AS pax FROM panel GROUP BY route, month""")
def _rank(spark, sf):
    by_month = panel(spark, sf).groupBy("route", "month").agg(F.sum("pax").alias("pax"))
    w = Window.partitionBy("route").orderBy(F.col("pax").desc(), "month")
    return by_month.withColumn("rank", F.row_number().over(w))


@query("f01_sorted_panel", P + f"SELECT route, {DAY}, pax FROM panel ORDER BY route, date")
def _sorted(spark, sf):
    return iso(panel(spark, sf).select("route", "date", "pax").orderBy("route", "date"))


# Functions ---------------------------------------------------------------------------------------------------------

@query("g01_logs", P + f"""SELECT route, {DAY}, round(ln(pax), 8) AS ln_pax, round(ln(yield_aud), 8) AS ln_yield,
    round(ln(fuel_index), 8) AS ln_fuel FROM panel WHERE pax > 0""")
def _logs(spark, sf):
    logs = panel(spark, sf).filter(F.col("pax") > 0)
    return rounded(logs.select("route", "date", F.ln("pax").alias("ln_pax"), F.ln("yield_aud").alias("ln_yield"),
                               F.ln("fuel_index").alias("ln_fuel")), {"ln_pax": 8, "ln_yield": 8, "ln_fuel": 8})


@query("g02_math", P + f"""SELECT route, {DAY}, round(exp(-load_factor), 8) AS e, round(sqrt(yield_aud), 6) AS s,
    abs(pax - 5000) AS a, round(power(load_factor, 2), 8) AS p FROM panel""")
def _math(spark, sf):
    return rounded(panel(spark, sf).select(
        "route", "date", F.exp(-F.col("load_factor")).alias("e"), F.sqrt("yield_aud").alias("s"),
        F.abs(F.col("pax") - 5000).alias("a"), F.pow("load_factor", F.lit(2)).alias("p")), {"e": 8, "s": 6, "p": 8})


@query("g03_bounds", P + f"""SELECT route, {DAY}, greatest(pax, 500) AS floor_pax, least(load_factor, 0.5) AS lf_cap FROM panel""")
def _bounds(spark, sf):
    return iso(panel(spark, sf).select("route", "date", F.greatest("pax", F.lit(500)).alias("floor_pax"),
                                       F.least("load_factor", F.lit(0.5)).alias("lf_cap")))


@query("g04_date_parts", P + f"SELECT route, {DAY}, week_of_year, year, month, quarter FROM panel")
def _date_parts(spark, sf):
    return iso(panel(spark, sf).select("route", "date", "week_of_year", "year", "month", "quarter"))


@query("g05_date_arithmetic", P + f"""SELECT route, {DAY}, date_diff('day', DATE '1995-01-02', date) AS days,
    strftime(date + 364, '%Y-%m-%d') AS next_year FROM panel""")
def _date_math(spark, sf):
    start = F.lit("1995-01-02").cast("date")
    return iso(panel(spark, sf).select("route", "date", F.datediff("date", start).cast("long").alias("days"),
                                       F.date_add("date", 7 * 52).alias("next_year")))


@query("g06_g07_containment", f"""WITH {PANEL}, {LOOKUPS} SELECT p.route, strftime(p.date, '%Y-%m-%d') AS date,
    contains(p.route, 'A') AS has_a, list_contains(competitors, 'RIVAL') AS has_rival FROM panel p JOIN routes r ON p.route = r.route""")
def _contains(spark, sf):
    joined = panel(spark, sf).join(demo(spark, "routes").select("route", "competitors"), "route")
    return iso(joined.select("route", "date", F.col("route").contains("A").alias("has_a"),
                             F.array_contains("competitors", F.lit("RIVAL")).alias("has_rival")))


INDEX_SQL = """power(1 + trend_pa, date_diff('day', DATE '1995-01-02', p.date) / 365.25::DOUBLE) AS trend,
    1 + 0.08::DOUBLE * sin(2 * pi() * week_of_year / 52) + 0.12::DOUBLE * cos(2 * pi() * week_of_year / 52)
      + 0.04::DOUBLE * sin(4 * pi() * week_of_year / 52) + 0.03::DOUBLE * cos(4 * pi() * week_of_year / 52) AS seasonal"""


def _indexed(spark, sf):
    dim = demo(spark, "routes").withColumnRenamed("business_mix", "dim_business_mix")
    joined = enrich.entity_attributes(enriched(spark, sf), dim)
    return joined.withColumns({"trend": fx.trend_index(F.col("date"), "1995-01-02", F.col("trend_pa")),
                               "seasonal": fx.seasonal_index(F.col("week_of_year"))})


INDEXED = f"""{ENRICHED}, indexed AS (SELECT p.*, r.base_pax_weekly, r.avg_yield, r.avg_load_factor, {INDEX_SQL}
    FROM enriched p JOIN routes r ON p.route = r.route)"""


@query("g08_trend_and_season", f"WITH {INDEXED} SELECT route, {DAY}, round(trend, 8) AS trend, round(seasonal, 8) AS seasonal FROM indexed")
def _season(spark, sf):
    return rounded(_indexed(spark, sf).select("route", "date", "trend", "seasonal"), {"trend": 8, "seasonal": 8})


def _demand(df):
    return fx.expected_demand(
        F.col("base_pax_weekly"), F.col("trend"), F.col("seasonal"), F.col("school_holiday"), F.col("public_holiday"),
        F.col("event_multiplier"), F.col("covid_factor"), F.col("rba_cash_rate"), F.col("macro_fuel"),
        F.col("business_mix"))


DEMAND_SQL = """base_pax_weekly * trend * seasonal * (1 + 0.14::DOUBLE * school_holiday * (1 - business_mix))
    * (1 + 0.06::DOUBLE * public_holiday) * event_multiplier * covid_factor
    * (1 - (rba_cash_rate - 0.015::DOUBLE) * business_mix * 0.8::DOUBLE)
    * (1 - greatest(0, (macro_fuel - 100) / 100) * 0.08::DOUBLE)"""


@query("g09_expected_demand", f"WITH {INDEXED} SELECT route, {DAY}, round({DEMAND_SQL}, 4) AS expected_pax FROM indexed")
def _expected_demand(spark, sf):
    df = _indexed(spark, sf)
    return rounded(df.select("route", "date", _demand(df).alias("expected_pax")), {"expected_pax": 4})


@query("g10_expected_yield", f"""WITH {INDEXED}, d AS (SELECT *, {DEMAND_SQL} AS expected_pax FROM indexed)
    SELECT route, {DAY}, greatest(80, round_even(avg_yield * cpi_index
        * (1 + (expected_pax / (base_pax_weekly * trend * seasonal + 1) - 1) * 0.35::DOUBLE)
        * (1 + greatest(0, (macro_fuel - 100) / 100) * 0.12::DOUBLE) * (1 - competition_index * 0.08::DOUBLE), 2)) AS expected_yield,
      round(least(0.99, greatest(0.05, least(0.99, greatest(0.3, avg_load_factor)) * covid_factor)), 6) AS expected_lf FROM d""")
def _expected_yield(spark, sf):
    df = _indexed(spark, sf)
    df = df.withColumn("expected_pax", _demand(df))
    value = fx.expected_yield(F.col("avg_yield"), F.col("cpi_index"), F.col("expected_pax"), F.col("base_pax_weekly"),
                              F.col("trend"), F.col("seasonal"), F.col("macro_fuel"), F.col("competition_index"))
    lf = fx.expected_load_factor(F.col("avg_load_factor"), F.col("covid_factor"))
    return rounded(df.select("route", "date", value.alias("expected_yield"), lf.alias("expected_lf")), {"expected_lf": 6})


@query("g14_nested_documents", P + """SELECT route, CAST(len(list(pax ORDER BY date)) AS BIGINT) AS weeks,
    to_json(list(pax ORDER BY date))::VARCHAR AS pax_series FROM panel GROUP BY route""")
def _nested(spark, sf):
    packed = F.array_sort(F.collect_list(F.struct("date", "pax")))
    rows = panel(spark, sf).groupBy("route").agg(packed.alias("rows"))
    series = F.transform("rows", lambda r: r["pax"])
    return rows.select("route", F.size("rows").cast("long").alias("weeks"), F.to_json(series).alias("pax_series"))
