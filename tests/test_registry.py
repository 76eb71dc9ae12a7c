"""Every registered query that has SQL gives the same rows as DuckDB on the smallest tables."""
import pytest

import __spark_entry__ as contract
from panelflume.registry import QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
# Queries whose observation gate leaves no row at this scale.
EMPTY = {"b08_min_observations", "j14_elasticity_many_routes"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, duck, name):
    ok, note = compare(QUERIES[name].run(spark, SF), duck, QUERIES[name].sql)
    assert ok or (name in EMPTY and note == "0 rows"), note


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert {"outcome", "att", "att_se"} <= set(contract.entry(spark).columns)
    assert contract.entry(spark).count() == 2


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_join_pairs_all_rows(spark, no_broadcast, name):
    """Also when no side is small enough to broadcast."""
    plan = QUERIES[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "BroadcastHashJoin" not in plan


SHUFFLED = ["a07_panel_scan_nation_brand", "e14_feature_frame", "e14_feature_frame_blocked", "h02_grid_search",
            "i08_bootstrap_interval", "j07_many_experiments", "j14_elasticity_table", "k08_route_allocation", "l02_scorecard"]


@pytest.mark.parametrize("name", SHUFFLED)
def test_matches_sql_with_shuffled_joins(spark, no_broadcast, duck, name):
    ok, note = compare(QUERIES[name].run(spark, SF), duck, QUERIES[name].sql)
    assert ok, note
