"""Hybrid forecaster: Holt-Winters per entity plus one boosted-tree model of the residuals of all entities.

The frame is built with one exchange on the entity: rows are packed per series, smoothed, and unpacked again. Trees are fitted by
Spark ML over all rows, so an entity of any size spreads, and the number of entities adds no jobs.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume import fixed_values as fv
from panelflume.operators import filters, metrics, residual_model, smoothing
from panelflume.sources.files import cut_lineage

LEVEL = "entity_level"


def smoothed_frame(feat: DataFrame, test_rows: int = fv.TEST_WEEKS, season: int = fv.SEASON_WEEKS,
                   names: list[str] | None = None) -> DataFrame:
    """One row per (route, date): features as array x, period, step, hw_fc, residual, components and parameters.

    Smoothing is fitted on all but the last test_rows of a series; those get forecasts, floored at zero. Series with
    no training rows are left out. x holds the features in `names` (all known ones) that exist, then the mean training level.
    """
    names = filters.present(feat, fv.FEATURE_COLS if names is None else names)
    x = F.array(*[F.col(c).cast("double") for c in names]).alias("x")
    packed = smoothing.series(feat.select("route", "date", "pax", x), "pax", carry=["x"])
    cut = (packed.filter(F.size("y") > test_rows)
           .withColumn("all_y", F.col("y")).withColumn("n_train", F.size("y") - test_rows)
           .withColumn("y", F.slice("y", F.lit(1), F.col("n_train"))))
    fitted = smoothing.grid_fit(cut, season)

    n, state = F.col("n_train"), F.col("state")
    level, trend = F.element_at("state.level", -1), F.element_at("state.trend", -1)

    def forecast(step: Column) -> Column:
        index = n - season + (step - 1) % season
        seasonal = F.when(index >= 0, F.coalesce(F.get(state["seasonal"], index), F.lit(0.0))).otherwise(0.0)
        return F.greatest(level + step * trend + seasonal, F.lit(0.0))

    ahead = F.transform(F.sequence(F.lit(1), F.lit(test_rows)), forecast)
    lagged = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        state["seasonal"], F.greatest(i - season, F.lit(0))))
    zipped = F.arrays_zip(
        F.col("rows"), F.concat(state["fitted"], ahead).alias("hw"), state["level"].alias("level"),
        state["trend"].alias("trend"), lagged.alias("seasonal"))
    mean_level = F.aggregate("y", F.lit(0.0), lambda a, v: a + v) / n
    long = fitted.withColumn(LEVEL, mean_level).select(
        "route", "alpha", "beta", "gamma", "rmse", "n_train", LEVEL, F.posexplode(zipped).alias("pos", "r"))
    train = F.col("pos") < n
    return long.select(
        "route", "r.rows.date", F.when(train, "train").otherwise("test").alias("period"),
        F.when(~train, F.col("pos") - n + 1).alias("step"), F.col("r.rows.y").alias("actual"),
        F.concat("r.rows.x", F.array(LEVEL)).alias("x"), F.col("r.hw").alias("hw_fc"),
        F.when(train, F.col("r.rows.y") - F.col("r.hw")).alias("residual"), "r.level", "r.trend", "r.seasonal",
        "alpha", "beta", "gamma", "rmse")


def left_out(feat: DataFrame, test_rows: int = fv.TEST_WEEKS) -> DataFrame:
    """Routes that smoothed_frame() leaves out, with their number of rows and the reason."""
    counts = feat.groupBy("route").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") <= test_rows)
    return counts.withColumn("reason", F.lit(f"no training rows: at most {test_rows} rows"))


def fit_residuals(train: DataFrame, trees: int, keys: tuple[str, ...] = ("route", "date"), params: dict | None = None) -> residual_model.Boosted:
    """params replaces any of depth, subsample, min_leaf, seed and stage_trees."""
    p = {**fv.BOOST_PARAMS, "stage_trees": residual_model.STAGE_TREES, **(params or {})}
    return residual_model.fit(train, trees, p["depth"], p["subsample"], p["min_leaf"], p["seed"], keys, p["stage_trees"])


def boost(frame: DataFrame, trees: int = fv.BOOST_PARAMS["trees"], params: dict | None = None) -> DataFrame:
    """Add boost, the modelled residual, and hybrid_fc, the smoothed value plus the correction, floored at zero.

    The model is fitted on the rows of period 'train' of all entities.
    """
    model = fit_residuals(frame.filter(F.col("period") == "train"), trees, params=params)
    return combined(residual_model.predict(model, frame))


def combined(scored: DataFrame) -> DataFrame:
    return scored.withColumn("hybrid_fc", F.greatest(F.col("hw_fc") + F.col("boost"), F.lit(0.0)))


def cross_validate(frame: DataFrame, folds: int = fv.CV_FOLDS, fold_rows: int = fv.CV_FOLD_WEEKS,
                   trees: int = fv.CV_TREES, feat: DataFrame | None = None, params: dict | None = None) -> DataFrame:
    """Walk-forward folds over the training rows: (route, fold, mape, rmse, n_train, n_val).

    The smoothing of the whole training part is reused in every fold. Given the feature frame `feat`, smoothing is
    refitted on the rows before each fold instead. One model per fold, for all entities.
    """
    marked = filters.walk_forward(frame.filter(F.col("period") == "train"), folds, fold_rows)
    if feat is not None:
        marked = cut_lineage(marked)
        refitted = None
        for fold in range(1, folds + 1):
            rows = marked.filter(F.col("fold") == fold).select("route", "date")
            again = smoothed_frame(feat.join(rows, ["route", "date"], "left_semi"), fold_rows).withColumns({
                "fold": F.lit(fold), "role": F.when(F.col("period") == "train", "train").otherwise("val")})
            refitted = again if refitted is None else refitted.unionByName(again)
        marked = refitted
    rows = cut_lineage(marked.select("route", "fold", "role", "date", "x", "residual", "actual", "hw_fc"))

    def scored_fold(fold: int) -> DataFrame:
        one = rows.filter(F.col("fold") == fold)
        return residual_model.predict(fit_residuals(one.filter(F.col("role") == "train"), trees, params=params), one)

    with ThreadPoolExecutor(folds) as pool:  # folds are fitted side by side, as their jobs are short
        parts = list(pool.map(inheritable_thread_target(rows.sparkSession)(scored_fold), range(1, folds + 1)))
    scored = combined(reduce(DataFrame.unionByName, parts))
    val = F.col("role") == "val"
    y, f = F.when(val, F.col("actual")), F.when(val, F.col("hybrid_fc"))
    return scored.groupBy("route", "fold").agg(
        metrics.mape(y, f).alias("mape"), metrics.rmse(y, f).alias("rmse"),
        F.count_if(~val).alias("n_train"), F.count_if(val).alias("n_val"))


def cv_summary(cv: DataFrame) -> DataFrame:
    return cv.groupBy("route").agg(F.avg("mape").alias("cv_mape_mean"), F.stddev_pop("mape").alias("cv_mape_std"))


def draw_index(size: Column, *parts: Column) -> Column:
    """Position in [0, size) that depends only on parts, so results do not vary with partitioning or retries."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), size.cast("long")).cast("int")


def quantile(ordered: Column, q: float) -> Column:
    """Linear-interpolation quantile of a sorted array."""
    at = (F.size(ordered) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    left = F.get(ordered, low)
    right = F.get(ordered, F.least(low + 1, F.size(ordered) - 1))
    return left + (right - left) * (at - low)


def bootstrap_interval(test: DataFrame, residuals: DataFrame, draws: int = fv.BOOTSTRAP_DRAWS, ci: float = 0.95,
                       seed: int = 42) -> DataFrame:
    """Add ci_low and ci_high to rows (route, step, hybrid_fc) from resampled residuals (route, date, residual).

    The resamples of a row stay in one array on that row; nothing is joined with or exploded by the draw number.
    """
    pool = residuals.groupBy("route").agg(
        F.array_sort(F.collect_list(F.struct("date", "residual"))).alias("_pool"))
    joined = test.join(pool, "route").withColumn("_r", F.transform("_pool", lambda r: r["residual"]))

    def draw(b: Column) -> Column:
        picked = F.get("_r", draw_index(F.size("_r"), F.col("route"), F.col("step"), b, F.lit(seed)))
        return F.greatest(F.col("hybrid_fc") + picked, F.lit(0.0))

    boot = joined.withColumn("_boot", F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), draw)))
    tail = (1 - ci) / 2
    return boot.withColumns({"ci_low": quantile(F.col("_boot"), tail), "ci_high": quantile(F.col("_boot"), 1 - tail)}
                            ).drop("_pool", "_r", "_boot")


def permuted(train: DataFrame, names: list[str], repeats: int, spread: int = 6, only: set[int] | None = None) -> DataFrame:
    """Rows (route, feature_code, repeat, date, residual, x): x with one feature shuffled among the rows of its route. `only`
    limits it to the features at these positions.

    The shuffle orders rows by a hash of (route, feature, repeat, row) on the packed series. A packed series is sent to
    `spread` places, each of which works off its share of the features, so few entities still fill many tasks.
    """
    labels = F.array(*[F.lit(n) for n in names])
    packed = train.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("date", "residual", "x"))).alias("rows"))
    placed = smoothing.by_entity(
        packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))), "route", "slot")
    tried = F.array(*[F.lit(f) for f in (range(len(names)) if only is None else sorted(only))]).cast("array<int>")
    mine = F.filter(tried, lambda f: f % spread == F.col("slot"))
    trials = placed.withColumn("f", F.explode(mine)).withColumn(
        "repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    keys = F.transform(F.sequence(F.lit(0), F.size("rows") - 1), lambda i: F.struct(
        F.md5(F.concat_ws("|", "route", F.get(labels, F.col("f")), F.col("repeat").cast("string"), i.cast("string"))
              ).alias("h"), i.alias("i")))
    donors = F.transform(F.array_sort(keys), lambda k: F.get(F.get(F.col("rows"), k["i"])["x"], F.col("f")))
    zipped = F.arrays_zip(F.col("rows"), donors.alias("donor"))
    long = trials.select("route", "f", "repeat", F.explode(zipped).alias("r"))
    swapped = F.transform("r.rows.x", lambda v, i: F.when(i == F.col("f"), F.col("r.donor")).otherwise(v))
    return long.select("route", F.get(labels, F.col("f")).alias("feature_code"), "repeat", "r.rows.date", "r.rows.residual",
                       swapped.alias("x"))


def importance(frame: DataFrame, names: list[str], trees: int = fv.BOOST_PARAMS["trees"],
               repeats: int = fv.IMPORTANCE_REPEATS, params: dict | None = None) -> DataFrame:
    """Rise of a route's squared training error when a feature is shuffled within it: mean and population deviation over repeats, ranked.

    Shuffles are rows, scored by the model like any others. A feature that no tree splits on has importance zero, exactly, and is not
    tried; so has one that is constant in a route, as rises are taken row by row.
    """
    train = cut_lineage(frame.filter(F.col("period") == "train").select("route", "date", "x", "residual"))
    model = fit_residuals(train, trees, params=params)
    used = {i for i in model.used() if i < len(names)}
    gap = F.col("residual") - F.col("boost")
    plain = residual_model.predict(model, train).select("route", "date", (gap * gap).alias("base"))
    tried = residual_model.predict(model, permuted(train, names, repeats, only=used))
    rise = tried.withColumn("error", gap * gap).join(plain, ["route", "date"]).groupBy("route", "feature_code", "repeat").agg(
        F.avg(F.col("error") - F.col("base")).alias("rise"))
    table = rise.groupBy("route", "feature_code").agg(F.avg("rise").alias("importance"), F.stddev_pop("rise").alias("importance_std"))
    unused = F.array(*[F.lit(n) for i, n in enumerate(names) if i not in used]).cast("array<string>")
    rest = train.select("route").distinct().select("route", F.explode(unused).alias("feature_code"), F.lit(0.0).alias("importance"), F.lit(0.0).alias("importance_std"))
    return label(metrics.top_per_group(table.unionByName(rest), "importance", len(names)))


def importance_table(plain: DataFrame, shuffled: DataFrame, features: int) -> DataFrame:
    """Ranked importances from scored rows with columns residual and boost, as they are and shuffled."""
    error = F.avg((F.col("residual") - F.col("boost")) * (F.col("residual") - F.col("boost")))
    base = plain.groupBy("route").agg(error.alias("base_mse"))
    trials = shuffled.groupBy("route", "feature_code", "repeat").agg(error.alias("mse"))
    rise = trials.join(base, "route").withColumn("rise", F.col("mse") - F.col("base_mse"))
    table = rise.groupBy("route", "feature_code").agg(
        F.avg("rise").alias("importance"), F.stddev_pop("rise").alias("importance_std"))
    return metrics.top_per_group(table, "importance", features)


def label(df: DataFrame) -> DataFrame:
    """Display name of feature_code; an unknown code names itself."""
    known = F.create_map(*[F.lit(v) for pair in fv.FEATURES for v in pair])
    return df.withColumn("feature", F.coalesce(F.try_element_at(known, F.col("feature_code")), F.col("feature_code")))


def forecast_table(scored: DataFrame, last_train: int = fv.SEASON_WEEKS) -> DataFrame:
    """Test rows with intervals and the last training rows without, values cut to whole numbers.

    Input columns: route, date, period, actual, hybrid_fc, hw_fc and, for test rows, ci_low and ci_high.
    """
    test = F.col("period") == "test"
    back = F.row_number().over(Window.partitionBy("route", "period").orderBy(F.col("date").desc()))
    kept = scored.withColumn("_back", back).filter(test | (F.col("_back") <= last_train))
    values = {c: F.col(c).cast("long") for c in ("actual", "hybrid_fc", "hw_fc")}
    values["ci_low"] = F.when(test & F.col("ci_low").isNotNull(), F.greatest(F.col("ci_low"), F.lit(0.0))).cast("long")
    values["ci_high"] = F.when(test, F.col("ci_high")).cast("long")
    return kept.withColumns(values).select("route", "date", "period", "actual", "hybrid_fc", "hw_fc", "ci_low", "ci_high")
