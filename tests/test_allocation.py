import itertools

import numpy as np
import pytest

from panelflume import fixed_values as fv
from panelflume.operators import allocation
from panelflume.plans import stages


def one(spark, **kw):
    base = {"forecast_pax": 160.0, **kw}
    return allocation.optimise(spark.createDataFrame([tuple(base.values())], list(base))).first()


def best_vertex(pax, cap, lf, ob, eco, first, y):
    """Optimum by trying every vertex of the feasible set."""
    fill = np.array(fv.FILL_RATES)
    d = np.minimum(fill * min(fv.FILL_SIGNAL_CAP, pax / max(cap * lf, 1)), fill)
    low, high = np.array([first * cap, 0, 0, eco * cap]), np.array(fv.MAX_MIX) * cap
    rows = [(np.ones(4), cap * (1 + ob)), (d, lf * cap)] + [(e, b) for i, e in enumerate(np.eye(4)) for b in (low[i], high[i])]
    best = None
    for pick in itertools.combinations(rows, 4):
        a = np.array([r for r, _ in pick])
        if abs(np.linalg.det(a)) < 1e-12:
            continue
        x = np.linalg.solve(a, [b for _, b in pick])
        if (x >= low - 1e-7).all() and (x <= high + 1e-7).all() and x.sum() <= cap * (1 + ob) + 1e-7 and d @ x >= lf * cap - 1e-7:
            value = (y * d) @ x
            best = value if best is None else max(best, value)
    return best


def test_kernel_finds_the_best_vertex():
    rng = np.random.default_rng(4)
    n = 300
    pax, cap = rng.uniform(100, 260, n), rng.uniform(60, 220, n)
    pax *= cap / 189
    lf, ob = rng.uniform(.6, .9, n), rng.uniform(0, .5, n)
    eco, first = rng.uniform(.2, .85, n), rng.uniform(0, .13, n)
    y = rng.uniform(50, 4000, (n, 4))
    y[::5] = np.sort(y[::5], axis=1)
    seats, revenue, shadow, ok = allocation.solve(pax, cap, lf, ob, eco, first, y)
    assert 50 < ok.sum() < n - 20
    for i in range(n):
        expected = best_vertex(pax[i], cap[i], lf[i], ob[i], eco[i], first[i], y[i])
        assert ok[i] == (expected is not None), i
        if ok[i]:
            assert revenue[i] == pytest.approx(expected, rel=1e-8), i
            less = best_vertex(pax[i], cap[i], lf[i], ob[i] - 1e-6, eco[i], first[i], y[i])
            if less is not None:
                assert shadow[i] == pytest.approx((expected - less) / (1e-6 * cap[i]), rel=1e-3, abs=1e-2), i


def test_record_at_defaults(spark):
    r = one(spark, forecast_pax=160.0)
    assert r["lp_success"] and r["expected_revenue"] == 203983 and r["bid_price_eco"] == pytest.approx(575.66)
    full = one(spark, forecast_pax=500.0)
    assert full["expected_revenue"] == 204812 and full["bid_price_eco"] == 578.0 and full["flat_baseline_rev"] == 142031
    assert sum(full[f"{c}_seats"] for c in fv.CABINS) <= 189 * 1.05 + 1
    assert full["eco_seats"] >= .45 * 189 - 1 and full["first_seats"] >= .05 * 189 - 1


def test_infeasible_falls_back_to_the_mix(spark):
    r = one(spark, forecast_pax=50.0)
    assert not r["lp_success"] and r["eco_seats"] == round(.62 * 189)
    d = .92 * 50 / (189 * .85)
    assert r["bid_price_eco"] == pytest.approx(310 * d, abs=.01)


def test_zero_parameters_take_the_default(spark):
    assert one(spark, capacity=0.0, ob_rate=0.0)["expected_revenue"] == one(spark)["expected_revenue"]


def test_doubling_yields_raises_revenue(spark):
    doubled = {f"y_{c}": 2 * v for c, v in fv.CABIN_YIELDS.items()}
    assert one(spark, **doubled)["expected_revenue"] > one(spark)["expected_revenue"]


def test_sweep(spark):
    df = spark.createDataFrame([("R", 160.0)], ["route", "forecast_pax"])
    rows = allocation.sensitivity(df, ["route"], grid=[85, 95, 105, 115]).orderBy("eco_seats").collect()
    assert len(rows) == 4 and rows[-1]["expected_revenue"] <= rows[0]["expected_revenue"]
    stage = allocation.sensitivity(df, ["route"], high=fv.STAGE_SWEEP_HIGH).collect()
    assert sorted(r["eco_seats"] for r in stage) == list(range(75, 143, 5))


def test_stage_tables(spark):
    fc = spark.createDataFrame([("SYD-MEL", "test", 27000.0), ("XXX-YYY", "test", 9000.0), ("SYD-MEL", "train", 1.0)],
                               ["route", "period", "hybrid_fc"])
    panel = spark.createDataFrame([("SYD-MEL", 189.0), ("XXX-YYY", 378.0)], ["route", "yield_aud"])
    out = stages.allocate(fc, panel)
    lp = {r["route"]: r for r in out["lp_results"].collect()}
    assert lp["SYD-MEL"]["forecast_pax"] == round(27000 * .58 / 98) and lp["XXX-YYY"]["forecast_pax"] == round(9000 * .58 / 35)
    assert lp["XXX-YYY"]["flat_baseline_rev"] == pytest.approx(2 * 142030.66, abs=1)
    assert out["lp_sensitivity"].count() == 28


def test_sweep_of_missing_and_tiny_capacities(spark):
    df = spark.createDataFrame([("null", None, 160.0), ("zero", 0.0, 160.0), ("one", 1.0, 160.0), ("usual", 189.0, 160.0)],
                               "route string, capacity double, forecast_pax double")
    steps = {}
    for r in allocation.sensitivity(df, ["route"]).collect():
        steps.setdefault(r["route"], []).append((r["eco_seats"], r["expected_revenue"]))
    assert sorted(steps["null"]) == sorted(steps["usual"]) == sorted(steps["zero"]) and "one" not in steps
