import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from panelflume import fixed_values as fv
from panelflume.operators import blocks, features, filters
from panelflume.operators.enrich import densify


def weekly(n=200, route="TEST", start="2019-01-07", seed=0):
    rng = np.random.default_rng(seed)
    dates = pd.date_range(start, periods=n, freq="7D")
    return pd.DataFrame({
        "date": dates.date, "route": route, "pax": rng.integers(5000, 15000, n), "yield_aud": rng.uniform(150, 350, n),
        "load_factor": rng.uniform(.7, .95, n), "school_holiday": rng.integers(0, 2, n),
        "public_holiday": rng.integers(0, 2, n), "event_multiplier": rng.uniform(1, 1.3, n), "covid_factor": 1.0,
        "competition_index": .4, "rba_cash_rate": .03, "fuel_index": 100.0, "cpi_index": 1.0, "business_mix": .2,
        "week_of_year": dates.isocalendar().week.to_numpy().astype(int), "year": dates.year, "month": dates.month,
        "quarter": dates.quarter})


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(weekly()).persist()


@pytest.fixture(scope="module")
def frame(panel):
    return features.add_features(panel).toPandas()


def test_all_features_present_and_filled(panel, frame):
    assert filters.missing(features.add_features(panel), fv.FEATURE_COLS) == []
    assert not frame[fv.FEATURE_COLS].isna().any().any()


def test_lag_52_decides_the_rows(panel, frame):
    assert len(frame) == 148
    assert features.add_features(panel, drop_na=False).count() == 200


def test_ranges(frame):
    for c in ("week_sin", "week_cos", "month_sin", "month_cos"):
        assert frame[c].between(-1, 1).all()
    assert set(frame.is_summer) | set(frame.is_winter) <= {0, 1}
    assert frame.pax_yoy_growth.between(-1, 5).all()
    assert np.isfinite(frame.pax_vs_rolling).all()


def test_against_pandas(frame):
    d = weekly()
    d["m4"], d["s4"] = d.pax.rolling(4, min_periods=1).mean(), d.pax.rolling(4, min_periods=1).std().fillna(0)
    d["l52"] = d.pax.shift(52)
    d = d.dropna().reset_index(drop=True)
    f = frame.sort_values("date").reset_index(drop=True)
    np.testing.assert_allclose(f.rolling_mean_4w, d.m4)
    np.testing.assert_allclose(f.rolling_std_4w, d.s4, rtol=1e-9)
    np.testing.assert_allclose(f.pax_lag52, d.l52)


def test_growth_is_clipped(spark):
    d = weekly(60)
    d.loc[:7, "pax"] = 0
    f = features.add_features(spark.createDataFrame(d)).toPandas()
    assert f.pax_yoy_growth.max() == 5


@pytest.mark.parametrize("leak_free", [False, True])
@pytest.mark.parametrize("block_rows", [53, 64, 150, 1000])
def test_blocks_equal_plain_windows(spark, leak_free, block_rows):
    d = pd.concat([weekly(300, "A", seed=1), weekly(7, "B", seed=2), weekly(120, "C", "2019-12-02", seed=3)])
    p = spark.createDataFrame(d)
    cols = ["route", "date", *fv.FEATURE_COLS]
    plain = features.add_features(p, drop_na=False, leak_free=leak_free).select(cols).toPandas()
    split = features.add_features(p, drop_na=False, leak_free=leak_free, block_rows=block_rows).select(cols).toPandas()
    key = ["route", "date"]
    pd.testing.assert_frame_equal(plain.sort_values(key).reset_index(drop=True),
                                  split.sort_values(key).reset_index(drop=True), rtol=1e-9)


def test_blocks_spread_one_entity(spark):
    p = spark.createDataFrame(weekly(300, "A"))
    halo = blocks.with_halo(blocks.with_positions(p, F.year("date")), 53, 60)
    sizes = halo.groupBy("block").count().toPandas()
    assert sizes["count"].max() <= 60 + 53 and len(sizes) >= 5


def test_numbering_by_buckets_equals_windows(spark):
    p = spark.createDataFrame(pd.concat([weekly(100, "A"), weekly(40, "B", seed=1)])).select("route", "date")
    year = F.year("date")
    assert filters.holdout_split(p, 26).exceptAll(filters.holdout_split(p, 26, bucket=year)).count() == 0
    assert filters.tail(p, 52).exceptAll(filters.tail(p, 52, bucket=year)).count() == 0
    assert filters.walk_forward(p, 3, 8).exceptAll(filters.walk_forward(p, 3, 8, bucket=year)).count() == 0


def test_leak_free_ignores_the_current_target(spark):
    d = weekly(120)
    e = d.copy()
    e.loc[119, "pax"] = 999_999
    cols = ["pax_yoy_growth", "rolling_mean_4w", "rolling_std_4w", "rolling_mean_13w", "pax_vs_rolling"]
    last = [features.add_features(spark.createDataFrame(x), leak_free=True).orderBy(F.col("date").desc()).select(cols).first()
            for x in (d, e)]
    assert last[0] == last[1]


def test_positional_lag_needs_densified_dates(spark):
    d = weekly(60).drop(index=30)
    p = spark.createDataFrame(d).select("route", "date", "pax")
    full = densify(p, fill={"pax": 0})
    assert full.count() == 60
    w = Window.partitionBy("route").orderBy("date")
    row = full.withColumn("lag", F.lag("pax", 4).over(w)).filter(F.col("pax") == 0).first()
    assert row["date"] == dt.date(2019, 1, 7) + dt.timedelta(weeks=30)


def test_walk_forward_tiles_the_tail(spark):
    p = spark.createDataFrame(weekly(100)).select("route", "date")
    folds = filters.walk_forward(p, 3, 8).groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")).toPandas().set_index(["fold", "role"])
    assert [folds.loc[(f, "train"), "n"] for f in (1, 2, 3)] == [76, 84, 92]
    assert all(folds.loc[(f, "val"), "n"] == 8 for f in (1, 2, 3))
    assert all(folds.loc[(f, "train"), "hi"] < folds.loc[(f, "val"), "lo"] for f in (1, 2, 3))
