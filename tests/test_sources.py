import datetime as dt
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from panelflume import fixed_values as fv
from panelflume.operators import enrich
from panelflume.plans import stages
from panelflume.sources import files, lookups, panel
from panelflume.sources.star import PANEL_SCHEMA

SF = "/root/testdata/sf0.001"


def days(spark, *dates, route="SYD-MEL"):
    df = spark.createDataFrame([(route, dt.date.fromisoformat(d)) for d in dates], "route string, date date")
    return df.withColumn("year", F.year("date"))


def test_csv_and_json_round_trips(spark, tmp_path):
    p = panel(spark, SF)
    files.write_csv(p, f"{tmp_path}/a/b/csv")
    assert files.read_csv(spark, f"{tmp_path}/a/b/csv", PANEL_SCHEMA).exceptAll(p).count() == 0
    nested = p.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("date", "pax"))).alias("rows"))
    files.write_json(nested, f"{tmp_path}/json")
    back = files.read_json(spark, f"{tmp_path}/json", nested.schema)
    assert back.exceptAll(nested).count() == 0


def test_missing_files(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_csv(spark, f"{tmp_path}/none", PANEL_SCHEMA)
    empty = files.read_optional(spark, f"{tmp_path}/none", PANEL_SCHEMA)
    assert empty.count() == 0 and empty.columns == panel(spark, SF).columns


def test_export_by_entity(spark, tmp_path):
    p = panel(spark, SF)
    files.write_results({"forecasts": p, "model_metrics": p.groupBy("route").count()}, str(tmp_path))
    assert {f.name for f in (tmp_path / "forecasts").iterdir() if f.is_dir()} >= {"route=ASIA", "route=EUROPE"}
    assert spark.read.parquet(f"{tmp_path}/model_metrics").count() == 5


def test_lineage_cut_reads_back_the_same_rows(spark):
    p = panel(spark, SF)
    cut = files.cut_lineage(p)
    assert cut.exceptAll(p).count() == 0 and cut.count() == p.count()
    assert spark.conf.get("spark.checkpoint.dir") in cut.inputFiles()[0]


def test_filters_reach_the_scan(spark):
    plan = panel(spark, SF, start="1998-01-05", end="1998-03-02")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "l_orderkey" in line][0]
    assert "l_shipdate" not in scan


def test_small_lookup_tables_need_no_exchange(spark):
    plan = enrich.day_dimension(enrich.default_tables(spark)).select("day", "school_holiday")
    assert plan.count() > 300


def test_default_calendars(spark):
    d = days(spark, "2019-01-21", "2019-01-28", "2019-02-04", "2019-04-22", "2020-04-06", "2023-09-25")
    out = enrich.calendar(d, enrich.default_tables(spark)).orderBy("date").collect()
    assert [r["school_holiday"] for r in out] == [1, 1, 0, 0, 0, 1]
    assert [r["public_holiday"] for r in out] == [0, 1, 0, 1, 1, 0]
    w = (dt.date(2019, 1, 14) - dt.date(2019, 1, 21)).days / 7
    assert out[0]["event_multiplier"] == pytest.approx(round(1 + .18 * math.exp(-.5 * (w / 1.6) ** 2), 4))
    assert out[4]["covid_factor"] == pytest.approx(round(1 - .95 * 14 / 39, 4))
    assert out[0]["cpi_index"] == pytest.approx(1.017) and out[4]["cpi_index"] == pytest.approx(round(1.017 * 1.009, 4))
    # overlapping events add up; a route without the event city has none
    both = out[5]["event_multiplier"]
    afl, nrl = (5 / 7) / .8, (6 / 7) / .8
    assert both == pytest.approx(round(1 + .18 * math.exp(-.5 * afl ** 2) + .14 * math.exp(-.5 * nrl ** 2), 4))
    other = enrich.calendar(days(spark, "2023-09-25", route="ADL-PER"), enrich.default_tables(spark)).first()
    assert other["event_multiplier"] == 1


def test_years_without_macro_rows_take_defaults(spark):
    out = enrich.calendar(days(spark, "2031-01-06"), enrich.default_tables(spark)).first()
    assert (out["rba_cash_rate"], out["inflation"], out["macro_fuel"]) == (.035, .025, 100)
    listed = math.prod(1 + c for _, _, c, _ in fv.MACRO)
    assert out["cpi_index"] == pytest.approx(round(listed * 1.025 ** 7, 4))


def test_competition_rules(spark):
    dim = lookups.lookup(spark, "routes").select("route", "competitors", "business_mix", F.col("comp_capacity_share").alias("competition_index"))
    rows = dim.withColumn("year", F.explode(F.array(F.lit(2022), F.lit(2023), F.lit(2024))))
    out = {(r["route"], r["year"]): r["competition_index"]
           for r in enrich.competition_rules(rows, lookups.lookup(spark, "competition_rules")).collect()}
    assert out["SYD-MEL", 2024] == pytest.approx(.42 * .65) and out["SYD-MEL", 2023] == pytest.approx(.42 * 1.08)
    assert out["SYD-BNE", 2024] == .38 and out["BNE-PER", 2023] == .31 and out["SYD-MEL", 2022] == .42


def test_default_experiment_runs(spark):
    assert stages.experiment_specs(spark).first()["treatment_routes"] == ["SYD-ADL", "MEL-ADL"]


def test_every_order_is_counted(spark, tmp_path):
    """Also orders outside the weeks that the test tables cover."""
    for name in ("region", "nation", "customer", "part"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders, lines = spark.read.parquet(f"{SF}/orders.parquet"), spark.read.parquet(f"{SF}/lineitem.parquet")
    first = orders.select(F.min("o_orderkey")).first()[0]
    for shift, day in ((1, "1980-05-05"), (2, "2031-05-05")):
        key = F.lit(10 ** 9 + shift)
        orders = orders.unionByName(orders.filter(F.col("o_orderkey") == first).limit(1).withColumns(
            {"o_orderkey": key, "o_orderdate": F.lit(day).cast("timestamp_ntz")}))
        lines = lines.unionByName(lines.filter(F.col("l_orderkey") < 10 ** 9).limit(1).withColumn("l_orderkey", key))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    dates = {str(r[0]) for r in panel(spark, str(tmp_path)).select("date").distinct().collect()}
    assert {"1980-05-05", "2031-05-05"} <= dates


def test_reversed_intervals_and_empty_regimes_touch_no_day(spark):
    d = dt.date.fromisoformat
    school = spark.createDataFrame([(d("2024-02-10"), d("2024-02-01"))], "start_date date, end_date date")
    assert enrich.school_holidays(days(spark, "2024-02-05"), school).first()["school_holiday"] == 0
    regimes = spark.createDataFrame([(d("2024-02-05"), d("2024-02-05"), .5, .5)], "from_date date, to_date date, v0 double, v1 double")
    assert enrich.regime_factor(days(spark, "2024-02-05"), regimes).first()["covid_factor"] == 1.0
    events = spark.createDataFrame([("e", d("2024-02-05"), "SYD", 1.5, -3)], "event_id string, event_date date, city string, peak_mult double, lead_weeks int")
    assert enrich.event_multiplier(days(spark, "2024-02-12"), events).first()["event_multiplier"] == 1.0


def test_years_beyond_the_year_table_get_the_defaults(spark):
    out = enrich.calendar(days(spark, "2150-01-05", "1850-01-07", "2100-01-04"), enrich.default_tables(spark)).orderBy("year").collect()
    assert all(r["rba_cash_rate"] == fv.DEFAULT_RATE and r["inflation"] == fv.DEFAULT_CPI and r["macro_fuel"] == fv.DEFAULT_FUEL for r in out)
    assert out[0]["cpi_index"] == 1.0
    assert out[2]["cpi_index"] == pytest.approx(out[1]["cpi_index"] * (1 + fv.DEFAULT_CPI) ** 50, rel=1e-4)


def test_lines_are_reduced_to_located_orders_before_they_are_summed(spark):
    plan = panel(spark, SF, entities=["ASIA"])._jdf.queryExecution().optimizedPlan().toString()
    lines = [i for i, x in enumerate(plan.splitlines()) if "LeftSemi" in x]
    sums = [i for i, x in enumerate(plan.splitlines()) if "Aggregate [l_orderkey" in x]
    assert lines and sums and sums[0] < lines[0]


def test_listed_years_outside_the_usual_table_count(spark):
    tables = dict(enrich.default_tables(spark))
    extra = spark.createDataFrame([(2150, .09, .05, 300.0), (1850, .08, .04, 50.0)], "year int, rate double, cpi double, fuel double")
    tables["macro"] = tables["macro"].select("year", "rate", "cpi", "fuel").unionByName(extra)
    out = {r["date"].year: r for r in enrich.calendar(days(spark, "2150-01-05", "1850-01-07", "2149-01-06", "2160-01-07"), tables).collect()}
    for year, row in ((2150, (.09, .05, 300.0)), (1850, (.08, .04, 50.0))):
        assert (out[year]["rba_cash_rate"], out[year]["inflation"], out[year]["macro_fuel"]) == row
    assert out[2150]["cpi_index"] == pytest.approx(out[2149]["cpi_index"] * 1.05, rel=1e-4)
    assert out[2160]["cpi_index"] == pytest.approx(out[2150]["cpi_index"] * 1.025 ** 10, rel=1e-4)
