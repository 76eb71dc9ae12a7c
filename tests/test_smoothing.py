import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelflume import fixed_values as fv
from panelflume.operators import smoothing, smoothing_blocks


def seasonal(n=104, seed=1):
    t = np.arange(n)
    return 1000 + 5 * t + 200 * np.sin(2 * np.pi * t / 52) + np.random.default_rng(seed).normal(0, 20, n)


def frame(spark, series):
    rows = [pd.DataFrame({"route": r, "date": pd.date_range("2019-01-07", periods=len(y), freq="7D").date, "pax": y})
            for r, y in series.items()]
    return spark.createDataFrame(pd.concat(rows))


def by_hand(y, a, b, g, m):
    """Plain loop over one series."""
    n = len(y)
    if n >= 2 * m:
        lv, tr = y[:m].mean(), (y[m:2 * m].mean() - y[:m].mean()) / m
    else:
        lv, tr = y[0], (y[-1] - y[0]) / max(n - 1, 1)
    s = {0: y[0] - lv if n >= m else 0.0}
    out = [(lv, tr, s[0], lv + tr + s[0])]
    for t in range(1, n):
        back = s[t - m] if t >= m else 0.0
        new = a * (y[t] - back) + (1 - a) * (lv + tr)
        tr = b * (new - lv) + (1 - b) * tr
        lv = new
        s[t] = g * (y[t] - lv) + (1 - g) * back
        out.append((lv, tr, s[t], lv + tr + back))
    return np.array(out)


@pytest.mark.parametrize("n", [1, 2, 10, 20, 60])
def test_fold_and_kernel_equal_a_plain_loop(spark, n):
    y, m = seasonal(n), 13
    expected = by_hand(y, .3, .1, .15, m)
    kernel = smoothing.states(y, np.array([[.3, .1, .15]]), m)
    np.testing.assert_allclose(np.column_stack([k[:, 0] for k in kernel]), expected, rtol=1e-12)
    state = smoothing.smooth(smoothing.series(frame(spark, {"a": y})), .3, .1, .15, m).first()["state"]
    for i, name in enumerate(("level", "trend", "seasonal", "fitted")):
        np.testing.assert_allclose(state[name], expected[:, i], rtol=1e-10)


@pytest.fixture(scope="module")
def fitted(spark):
    return smoothing.grid_fit(smoothing.series(frame(spark, {"a": seasonal(), "b": seasonal(150, 2)}))).persist()


def test_grid_search_takes_the_first_best(fitted):
    for row in fitted.collect():
        y, best = np.array(row["y"]), (np.inf, None)
        for a in fv.ALPHA_GRID:
            for b in fv.BETA_GRID:
                for g in fv.GAMMA_GRID:
                    e = np.sqrt(np.mean((y - by_hand(y, a, b, g, 52)[:, 3]) ** 2))
                    if e < best[0] - 1e-9:
                        best = (e, (a, b, g))
        assert (row["alpha"], row["beta"], row["gamma"]) == best[1]
        assert row["rmse"] == pytest.approx(best[0])


def test_components_and_residual_spread(fitted):
    rows = smoothing.fitted_rows(fitted, 52).toPandas()
    assert (rows.groupby("route").size() == pd.Series({"a": 104, "b": 150}, name="route")).all()
    assert (rows.groupby("route").residual.std() < rows.groupby("route").y.std()).all()
    assert np.isfinite(rows[["level", "trend", "seasonal", "residual"]]).all().all()


@pytest.mark.parametrize("steps", [1, 13, 26, 52, 60])
def test_forecast_length_and_cycle(fitted, steps):
    rows = smoothing.forecast_rows(fitted, steps, 52).filter(F.col("route") == "a").orderBy("step").toPandas()
    assert len(rows) == steps and np.isfinite(rows.hw_fc).all()
    st = fitted.filter(F.col("route") == "a").first()["state"]
    expected = [st["level"][-1] + h * st["trend"][-1] + st["seasonal"][104 - 52 + (h - 1) % 52] for h in range(1, steps + 1)]
    np.testing.assert_allclose(rows.hw_fc, expected)


def test_series_shorter_than_a_season(spark):
    y = seasonal(20)
    rows = smoothing.forecast_rows(smoothing.grid_fit(smoothing.series(frame(spark, {"a": y}))), 52, 52)
    assert rows.filter(F.col("hw_fc").isNull()).count() == 0


def test_decomposition_keeps_the_last_rows(fitted):
    d = smoothing.decomposition(smoothing.fitted_rows(fitted, 52)).filter(F.col("route") == "b").first()
    assert len(d["dates"]) == len(d["level"]) == 104 and d["dates"] == sorted(d["dates"])


def test_one_step_ahead_uses_the_state_before(spark):
    y, m = seasonal(40), 13
    e = by_hand(y, .3, .1, .15, m)
    st = smoothing.smooth(smoothing.series(frame(spark, {"a": y})), .3, .1, .15, m, one_step_ahead=True).first()["state"]
    assert st["fitted"][20] == pytest.approx(e[19, 0] + e[19, 1] + e[20 - m, 2])


def test_long_series_take_linear_time(spark):
    import time
    took = []
    for n in (2500, 10000):
        df = smoothing.series(frame(spark, {"a": np.sin(np.arange(n) / 9) + 3}))
        smoothing.smooth(df, .3, .1, .15, 52).select(F.size("state.level")).collect()
        begun = time.perf_counter()
        assert smoothing.smooth(df, .3, .1, .15, 52).select(F.size("state.level")).first()[0] == n
        took.append(time.perf_counter() - begun)
    assert took[1] < 8 * took[0]


def test_prefix_over_blocks_equals_one_pass(spark):
    n, season, params = 100_000, 52, (.3, .1, .15)
    t = np.arange(n)
    y = 1000 + 200 * np.sin(2 * np.pi * t / season) + np.random.default_rng(4).normal(0, 20, n)
    dates = (np.datetime64("1700-01-01") + t).astype("datetime64[D]")
    df = spark.createDataFrame(pd.DataFrame({"route": "a", "date": dates.astype(object), "pax": y}))
    out = smoothing_blocks.smooth(df, *params, season, F.floor(F.datediff("date", F.lit("1700-01-01").cast("date")) / 5000), block_rows=10_000)
    rows = out.orderBy("position").toPandas()
    assert (rows.position // 10_036).nunique() >= 8
    level, trend, index, fitted = (a[:, 0] for a in smoothing.states(y, np.array([params]), season))
    for name, expected in (("level", level), ("trend", trend), ("index", index), ("fitted", fitted)):
        np.testing.assert_allclose(rows[name], expected, rtol=1e-9, atol=1e-9)
    ahead = smoothing_blocks.forecast(out, 60, season).orderBy("step").toPandas().hw_fc
    h = np.arange(60)
    np.testing.assert_allclose(ahead, level[-1] + (h + 1) * trend[-1] + index[n - season + h % season], rtol=1e-9)


@pytest.mark.parametrize("n", [1, 5, 13, 20, 27, 90])
def test_short_series_in_blocks(spark, n):
    df = frame(spark, {"a": seasonal(n), "b": seasonal(40, 2)})
    blocks = smoothing_blocks.smooth(df, .3, .1, .15, 13, F.year("date"), block_rows=13)
    whole = smoothing.fitted_rows(smoothing.smooth(smoothing.series(df), .3, .1, .15, 13), 13)
    cols = ["level", "trend", "seasonal", "fitted", "residual"]
    a, b = (x.orderBy("route", "date").toPandas()[cols].to_numpy() for x in (blocks, whole))
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)
    ahead = [x.orderBy("route", "step").toPandas().hw_fc for x in (smoothing_blocks.forecast(blocks, 20, 13), smoothing.forecast_rows(
        smoothing.smooth(smoothing.series(df), .3, .1, .15, 13), 20, 13))]
    np.testing.assert_allclose(*ahead, rtol=1e-9)
