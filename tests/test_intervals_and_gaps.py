import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelflume.operators import gaps, intervals
from panelflume.sources import files


def random_spans(rng, n):
    """From seconds to decades, some empty or reversed."""
    out = []
    for i in range(n):
        start = pd.Timestamp("1990-01-01") + pd.Timedelta(seconds=rng.uniform(0, 1e9))
        out.append((i, start, start + pd.Timedelta(seconds=rng.choice([0, -5, 1, 59, 61, 3600, 86400 * 9, 86400 * 365 * 12]) * rng.uniform(.5, 1.5)), rng.choice("ab")))
    return pd.DataFrame(out, columns=["span", "start", "end", "k"])


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_matches_equal_a_plain_range_join(spark, keys):
    rng = random.Random(3)
    spans = random_spans(rng, 120)
    points = pd.DataFrame([(i, pd.Timestamp("1990-01-01") + pd.Timedelta(seconds=rng.uniform(0, 1.2e9)), rng.choice("ab")) for i in range(300)]
                          + [(1000 + i, t, "a") for i, t in enumerate([*spans.start[:40], *spans.end[:40]])], columns=["point", "at", "k"])
    expected = {(p.point, s.span) for p in points.itertuples() for s in spans.itertuples() if s.start <= p.at < s.end and (not keys or s.k == p.k)}
    right = spans if keys else spans.drop(columns="k")
    out = intervals.matched(spark.createDataFrame(points), spark.createDataFrame(right), "at", keys=keys)
    assert sorted((r["point"], r["span"]) for r in out.select("point", "span").collect()) == sorted(expected)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket_" in plan


def test_no_intervals(spark):
    points = spark.sql("select 1L as id, timestamp '2020-01-01' as at")
    none = spark.createDataFrame([], "start timestamp, end timestamp, v0 double, v1 double")
    assert intervals.flagged(points, none, "id", "at", "hit").first()["hit"] == 0
    assert intervals.interpolated(points, none, "id", "at", "level").first()["level"] == 1.0


def pull(at):
    away = (F.unix_micros(at) - F.unix_micros("start")) / (F.unix_micros("end") - F.unix_micros("start")) - 0.4
    return F.col("v") * F.exp(F.lit(-8.0) * away * away)


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_smooth_sums_and_flags_equal_those_of_all_pairs(spark, keys):
    rng = random.Random(5)
    spans = random_spans(rng, 150)
    tiny = spans[:20].assign(end=spans.start[:20] + pd.Timedelta(microseconds=900))
    even = pd.DataFrame([(0, pd.Timestamp("2001-01-01"), pd.Timestamp("2001-01-01") + pd.Timedelta(microseconds=2 ** 34), "a")], columns=spans.columns)
    spans = pd.concat([spans, spans[:9], tiny, even])
    spans["v"] = [[1.5, -2.0, None, 1e9, float("nan"), float("inf")][rng.choice([0, 0, 1, 1, 0, 1, 2, 3]) if i % 60 else 4 + i // 60 % 2] for i in range(len(spans))]
    times = [pd.Timestamp("1990-01-01") + pd.Timedelta(seconds=rng.uniform(0, 1.2e9)) for _ in range(500)] + [*spans.start, *spans.end, *(spans.end - pd.Timedelta(microseconds=1))]
    points = spark.createDataFrame([(i // 2 if i % 7 else None, t.to_pydatetime() if i % 50 else None, rng.choice(["a", "b", "b", None])) for i, t in enumerate(times)],
                                   "id long, at timestamp, k string")
    right = [(s.start.to_pydatetime(), s.end.to_pydatetime(), s.k if i % 9 else None, None if pd.isna(v) and i % 60 else float(v))
             for i, (s, v) in enumerate(zip(spans.itertuples(), spans["v"]))]
    right = spark.createDataFrame(right, "start timestamp, end timestamp, k string, v double")
    right = right if keys else right.drop("k")

    def rows(df, name):
        return sorted(((r["id"], r["at"], r["k"], r[name]) for r in df.collect()), key=str)

    pairs = rows(intervals.summed(points, right, "id", "at", pull, "pull", keys=keys), "pull")
    sums = rows(intervals.summed(points, right, "id", "at", pull, "pull", nodes=24, keys=keys), "pull")
    assert {str(abs(p[3])) for p in pairs} >= {"0.0", "nan", "inf"} and [p[:3] for p in pairs] == [p[:3] for p in sums]
    np.testing.assert_allclose([p[3] for p in sums], [p[3] for p in pairs], rtol=1e-9, atol=1e-9)
    hit = intervals.matched(points, right, "at", keys=keys).select("id").distinct().toPandas().id
    flags = rows(intervals.flagged(points, right, "id", "at", "hit", keys=keys), "hit")
    assert [p[3] for p in flags] == [int(p[0] in set(hit)) for p in flags] and {p[3] for p in flags} == {0, 1}


@pytest.mark.parametrize("smooth", [True, False])
def test_overlapping_intervals_make_no_pairs(spark, smooth):
    """20,000 points in 20,000 intervals each, 400 million pairs: no operator hands on more than a few rows of each."""
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 50_000)
    points = spark.range(20_000).select("id", at.alias("at"))
    spans = spark.range(20_000).select(F.timestamp_seconds(F.lit(1_699_990_000) + F.col("id") / 1000).alias("start"),
                                       F.timestamp_seconds(F.lit(1_700_010_000) + F.col("id") / 1000).alias("end"), F.lit(1.0).alias("v"))
    if smooth:
        out = intervals.summed(points, spans, "id", "at", pull, "found", nodes=16)
    else:
        out = intervals.flagged(points, spans, "id", "at", "found")
    assert " Join Inner" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("found > 0").count() == 20_000
    if smooth:
        some = {r["id"]: r["found"] for r in out.where("id % 4000 = 7").collect()}
        pairs = intervals.summed(points.where("id % 4000 = 7"), spans, "id", "at", pull, "found")
        assert some and all(abs(some[r["id"]] / r["found"] - 1) < 1e-11 for r in pairs.collect())


def by_hand(values, policy, limit, season):
    out = []
    for i, v in enumerate(values):
        if v is None:
            last = next((j for j in range(i, -1, -1) if values[j] is not None), None)
            after = next((j for j in range(i, len(values)) if values[j] is not None), None)
            if policy == "forward" and last is not None and i - last <= limit:
                v = values[last]
            elif policy == "linear" and last is not None and after is not None and after - last <= limit + 1:
                v = values[last] + (values[after] - values[last]) * (i - last) / (after - last)
            elif policy == "seasonal" and last is not None and i - last <= limit and i >= season:
                v = values[i - season]
        out.append(v)
    return out


@pytest.mark.parametrize("bucketed", [False, True])
def test_filling(spark, bucketed):
    rng = random.Random(8)
    series = {r: [None if rng.random() < .4 else float(rng.randint(1, 99)) for _ in range(n)] for r, n in (("a", 150), ("b", 7), ("c", 1))}
    rows = [(r, d.date(), v, v, v) for r, vs in series.items() for d, v in zip(pd.date_range("2020-01-06", periods=150, freq="7D"), vs)]
    df = spark.createDataFrame(rows, "route string, date date, forward double, linear double, seasonal double")
    out = gaps.fill(df, {p: p for p in gaps.POLICIES}, 3, 13, bucket=F.year("date") if bucketed else None, block_rows=20).orderBy("route", "date").toPandas()
    assert len(out) == len(rows)
    for r, vs in series.items():
        for p in gaps.POLICIES:
            expected = np.array([np.nan if v is None else v for v in by_hand(vs, p, 3, 13)])
            np.testing.assert_allclose(out[out.route == r][p].to_numpy(float), expected)
    with pytest.raises(ValueError):
        gaps.fill(df, {"forward": "nearest"}, 3)


def test_an_export_is_read_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "route string, v int")

    def read(**options):
        return sorted(((r["route"], r["v"]) for r in files.read_export(spark, folder, "t", **options).collect()), key=str)

    with pytest.raises(FileNotFoundError):
        read()
    assert files.export({"t": rows, "u": rows}, folder) == 1
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "runs").rglob("*.parquet")}
    files.export({"t": rows.filter("route = 'a' and v = 1").withColumn("v", F.lit(9))}, folder, replace=True)
    assert read() == [("a", 9), ("b", 3), (None, 4)] and read(version=1) == [("a", 1), ("a", 2), ("b", 3), (None, 4)]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    with pytest.raises(Exception):    # fails on the second table: the first stays as it was
        files.export({"t": rows.limit(1), "u": rows.withColumn("v", F.raise_error(F.lit("broken")))}, folder)
    assert read() == [("a", 9), ("b", 3), (None, 4)]
    files.export({"t": rows.filter("route is null").withColumn("v", F.lit(7))}, folder, replace=True)
    assert read() == [("a", 9), ("b", 3), (None, 7)]
    assert files.export({"t": rows}, folder) == 4 and len(read()) == 4 and files.read_export(spark, folder, "u").count() == 4
