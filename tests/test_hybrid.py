import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelflume import fixed_values as fv
from panelflume.operators import features, filters, hybrid, residual_model
from panelflume.plans import serving, stages
from tests.test_features import weekly


def panel(routes=("AAA-BBB", "CCC-DDD")):
    parts = []
    for i, r in enumerate(routes):
        d = weekly(220, r, seed=i)
        t = np.arange(220)
        rng = np.random.default_rng(i)
        d["pax"] = (9000 + 1000 * i + 10 * t + 1500 * np.sin(2 * np.pi * t / 52) + 900 * d.school_holiday
                    + rng.normal(0, 150, 220)).astype(int)
        parts.append(d)
    return pd.concat(parts)


@pytest.fixture(scope="module")
def feat(spark):
    return features.add_features(spark.createDataFrame(panel())).persist()


@pytest.fixture(scope="module")
def frame(feat):
    return hybrid.smoothed_frame(feat).persist()


def test_frame_shape(frame, feat):
    assert frame.count() == feat.count() == 2 * 168
    counts = {(r["route"], r["period"]): r["count"] for r in frame.groupBy("route", "period").count().collect()}
    assert counts["AAA-BBB", "test"] == 26 and counts["AAA-BBB", "train"] == 142
    steps = frame.filter((F.col("period") == "test") & (F.col("route") == "AAA-BBB")).orderBy("date").select("step").collect()
    assert [s["step"] for s in steps] == list(range(1, 27))
    assert frame.filter(F.size("x") != len(fv.FEATURE_COLS) + 1).count() == 0


def test_boosting_lowers_the_training_error(frame):
    s = hybrid.boost(frame, 20).filter(F.col("period") == "train").select("residual", "boost").toPandas()
    assert np.mean((s.residual - s.boost) ** 2) < np.mean(s.residual ** 2)
    assert hybrid.boost(frame, 20).filter(F.col("hybrid_fc") < 0).count() == 0


def test_model_does_not_depend_on_partitions(frame):
    one, eight = (hybrid.boost(frame.repartition(k), 10).orderBy("route", "date").select("boost").toPandas().boost for k in (1, 8))
    assert (one == eight).all()


def test_forests_recover_a_step_and_handle_gaps(spark):
    rows = [("r", i, [float(i), None, 1.0, 1.0], -1.0 if i < 30 else 1.0) for i in range(60)]
    train = spark.createDataFrame(rows, "route string, date int, x array<double>, residual double")
    model = residual_model.fit(train, 600, 2, 1.0, 5, 1)
    got = residual_model.predict(model, train).toPandas()
    assert (got.boost - got.residual).abs().max() < .15 and (got.boost - got.residual).abs().mean() < .01 and model.used() == {0}
    assert residual_model.predict(residual_model.fit(train.limit(0), 3, 4, .8, 5, 1), train).filter("boost <> 0").count() == 0


def test_exported_nodes_give_the_predictions(spark, frame):
    train = frame.filter(F.col("period") == "train")
    model = hybrid.fit_residuals(train, 60)
    nodes = {(r["stage"], r["id"]): r for r in model.node_table().collect()}
    for row in residual_model.predict(model, train.limit(20)).collect():
        x, total = [residual_model.MISSING if v is None or v != v else v for v in row["x"]], 0.0
        for k, _ in enumerate(model.stages):
            roots = [n for (s, _), n in nodes.items() if s == k and n["root"]]
            for node in roots:
                while node["feature"] is not None:
                    node = nodes[k, node["left"] if x[node["feature"]] <= node["threshold"] else node["right"]]
                total += node["prediction"] / len(roots) * model.rate
        assert abs(total * row["x"][-1] - row["boost"]) < 1e-6 * max(1, abs(row["boost"]))


def test_short_routes_are_listed(spark):
    short = features.add_features(spark.createDataFrame(panel(("AAA-BBB",)))).limit(20)
    assert hybrid.smoothed_frame(short).count() == 0
    assert [(r["route"], r["n_rows"]) for r in hybrid.left_out(short).collect()] == [("AAA-BBB", 20)]


@pytest.mark.parametrize("refit", [False, True])
def test_cross_validation_table(frame, feat, refit):
    cv = hybrid.cross_validate(frame, trees=3, feat=feat if refit else None).orderBy("route", "fold").toPandas()
    assert cv.fold.tolist() == [1, 2, 3] * 2 and (cv.n_val == 8).all()
    assert cv.n_train.tolist() == [118, 126, 134] * 2 and (cv.mape > 0).all()


def test_importance_is_ranked_and_repeatable(frame):
    runs = [hybrid.importance(frame.repartition(k), fv.FEATURE_COLS, 20, 3).orderBy("route", "rank").toPandas() for k in (1, 5)]
    pd.testing.assert_frame_equal(runs[0], runs[1])
    top = runs[0][runs[0].route == "AAA-BBB"]
    assert top["rank"].tolist() == list(range(1, 31)) and top.importance.is_monotonic_decreasing
    assert (top.importance_std >= 0).all() and top.importance.iloc[0] > 0


def test_shuffle_keeps_the_values_of_the_feature(frame):
    train = frame.filter(F.col("period") == "train")
    names = fv.FEATURE_COLS
    p = hybrid.permuted(train, names, 1)
    k = names.index("pax_lag4")

    def column(df):
        return sorted(r[0] for r in df.filter(F.col("route") == "AAA-BBB").select(F.get("x", F.lit(k))).collect())

    mine = p.filter(F.col("feature_code") == "pax_lag4")
    assert column(mine) == column(train) and p.count() == train.count() * 30


def test_bootstrap_interval(spark):
    res = spark.createDataFrame([("r", d.date(), float(v)) for d, v in zip(pd.date_range("2020-01-06", periods=101, freq="7D"), range(-50, 51))],
                                "route string, date date, residual double")
    test = spark.createDataFrame([("r", 1, 1000.0), ("r", 2, 10.0)], "route string, step int, hybrid_fc double")
    rows = hybrid.bootstrap_interval(test, res).orderBy("step").collect()
    assert 945 < rows[0]["ci_low"] < 965 and 1035 < rows[0]["ci_high"] < 1055 and rows[1]["ci_low"] == 0


def test_stage_end_to_end(spark):
    out = stages.forecast(spark.createDataFrame(panel()), trees=5, cv_trees=3, repeats=2)
    m = out["model_metrics"].orderBy("route").collect()
    assert [r["route"] for r in m] == ["AAA-BBB", "CCC-DDD"] and all(r["n_test"] == 26 for r in m)
    assert all(0 < r["hybrid_mape"] < .5 and r["adf_p"] is not None and r["hw_alpha"] in fv.ALPHA_GRID for r in m)
    f = out["forecasts"].toPandas()
    assert len(f) == 2 * (26 + 52)
    test = f[f.period == "test"]
    assert (test.ci_low <= test.ci_high).all() and f[f.period == "train"].ci_low.isna().all()
    assert out["feature_importance"].count() == 60 and out["cv_results"].count() == 6
    assert len(out["decompositions"].first()["level"]) == 104
    lp = stages.allocate(out["forecasts"], spark.createDataFrame(panel()))["lp_results"]
    card = serving.scorecard(out["model_metrics"], spark.createDataFrame([("AAA-BBB", -.8)], "route string, preferred_elasticity double"), lp)
    assert card.count() == 2 and filters.present(card, ["adf_p", "revenue_uplift_pct"]) == ["adf_p", "revenue_uplift_pct"]
