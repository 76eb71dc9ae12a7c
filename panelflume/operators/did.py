"""Difference-in-differences, from one aggregate over the panel.

The model y ~ 1 + treated + post + treated*post is saturated, so its least-squares solution is the table of cell
means. Rows are reduced once to (experiment, outcome, treated, date) moments with map-side combine; cell means,
standard errors, and the placebo test (whose split date depends on the data) all come from that small table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelflume.functions.tails import student_t_p
from panelflume.operators.filters import date_window

SPEC_SHAPE = [
    ("experiment", "string"), ("treatment_date", "date"), ("treatment_routes", "array<string>"),
    ("control_routes", "array<string>"), ("pre_weeks", "int"), ("post_weeks", "int"),
]
KEYS = ["experiment", "outcome"]


def assign(panel: DataFrame, specs: DataFrame) -> DataFrame:
    """Rows of every experiment with dummy columns treated, post and did.

    A spec row becomes one row per listed route; the match on route is an equi-join, the date window its residual.
    """
    arms = specs.select(
        "experiment", "treatment_date", "pre_weeks", "post_weeks",
        F.explode(F.concat(
            F.transform("treatment_routes", lambda r: F.struct(r.alias("route"), F.lit(1).alias("treated"))),
            F.transform("control_routes", lambda r: F.struct(r.alias("route"), F.lit(0).alias("treated"))),
        )).alias("arm"),
    ).select("experiment", "treatment_date", "pre_weeks", "post_weeks", "arm.route", "arm.treated")
    inside = date_window(F.col("date"), F.col("treatment_date"), F.col("pre_weeks"), F.col("post_weeks"))
    post = (F.col("date") >= F.col("treatment_date")).cast("int")
    return (panel.join(arms, "route").filter(inside).withColumn("post", post)
            .withColumn("did", F.col("treated") * F.col("post")))


def daily_moments(assigned: DataFrame, outcomes: list[str]) -> DataFrame:
    """Count, mean and centred sum of squares per experiment, outcome, arm and date.

    All outcomes are aggregated side by side and only the aggregated rows are turned into one row per outcome.
    """
    keys = ["experiment", "pre_weeks", "treated", "post", "date"]

    def moment(o: str):
        y = F.col(o).cast("double")
        return F.struct(F.lit(o).alias("outcome"), F.count(y).alias("n"), F.avg(y).alias("mean"),
                        (F.var_pop(y) * F.count(y)).alias("m2"))

    wide = assigned.groupBy(*keys).agg(F.array(*[moment(o) for o in outcomes]).alias("_moments"))
    return wide.select(*keys, F.inline("_moments")).filter(F.col("n") > 0)


def arms(specs: DataFrame, bucket_days: int) -> DataFrame:
    """One row per experiment, listed route and bucket of days its window touches."""
    first, last = F.date_sub("treatment_date", F.col("pre_weeks") * 7), F.date_add("treatment_date", F.col("post_weeks") * 7)
    spread = specs.filter(first <= last).withColumn("bucket", F.explode(F.sequence(_bucket(first, bucket_days), _bucket(last, bucket_days))))
    sides = F.concat(F.transform("treatment_routes", lambda r: F.struct(r.alias("route"), F.lit(1).alias("treated"))),
                     F.transform("control_routes", lambda r: F.struct(r.alias("route"), F.lit(0).alias("treated"))))
    return spread.select("experiment", "treatment_date", "pre_weeks", "post_weeks", "bucket", F.inline(sides))


def _bucket(day, days: int):
    return F.floor(F.datediff(day, F.lit("1970-01-05").cast("date")) / F.lit(days)).cast("int")


def moments(panel: DataFrame, specs: DataFrame, outcomes: list[str], bucket_days: int = 56) -> DataFrame:
    """As daily_moments, but rows are first reduced to (route, date), which no experiment has a say in; only those meet the
    experiments, by route and bucket of days, so a row meets experiments near its date and the bounds follow from the specs.
    """
    days = panel.groupBy("route", "date").agg(day_moments(outcomes))
    return meet(days, specs, bucket_days)


def day_moments(outcomes: list[str]):
    """_moments: count, mean and centred sum of squares of each outcome, as an aggregate."""
    def moment(o: str):
        y = F.col(o).cast("double")
        return F.struct(F.lit(o).alias("outcome"), F.count(y).alias("n"), F.avg(y).alias("mean"), (F.var_pop(y) * F.count(y)).alias("m2"))

    return F.array(*[moment(o) for o in outcomes]).alias("_moments")


def meet(days: DataFrame, specs: DataFrame, bucket_days: int = 56) -> DataFrame:
    """Rows (route, date, _moments) matched with the experiments whose windows they lie in."""
    inside = date_window(F.col("date"), F.col("treatment_date"), F.col("pre_weeks"), F.col("post_weeks"))
    met = days.withColumn("bucket", _bucket(F.col("date"), bucket_days)).join(arms(specs, bucket_days), ["route", "bucket"]).filter(inside)
    post = (F.col("date") >= F.col("treatment_date")).cast("int")
    return merge_moments(met.select("experiment", "pre_weeks", "treated", post.alias("post"), "date", F.inline("_moments")).filter(F.col("n") > 0))


def merge_moments(moments: DataFrame) -> DataFrame:
    """Moments of disjoint sets of rows pooled to one row per key: the pooled mean first, then squares about it, so that no digits are
    lost to a large mean."""
    return pooled(moments, ["experiment", "pre_weeks", "treated", "post", "date", "outcome"])


def pooled(moments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, mean, m2) of rows with n, mean and m2. Both steps share one exchange of the reduced rows."""
    group = Window.partitionBy(*keys)
    centred = moments.withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group))
    gap = F.col("mean") - F.col("_mean")
    return centred.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"))


def cell_moments(moments: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Pool dates to cells: one row per key, treated and post with n, mean and m2."""
    return pooled(moments, [*keys, "treated", "post"])


def from_cells(cells: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Estimates from the 2x2 cells. Absent cells count as mean 0 and leave the standard error NULL."""
    def cell(tr: int, po: int, column: str):
        return F.max(F.when((F.col("treated") == tr) & (F.col("post") == po), F.col(column)))

    names = [(tr, po) for tr in (0, 1) for po in (0, 1)]
    wide = cells.groupBy(*keys).agg(
        *[F.coalesce(cell(tr, po, "n"), F.lit(0)).alias(f"n_{tr}_{po}") for tr, po in names],
        *[F.coalesce(cell(tr, po, "mean"), F.lit(0.0)).alias(f"mean_{tr}_{po}") for tr, po in names],
        *[F.coalesce(cell(tr, po, "m2"), F.lit(0.0)).alias(f"m2_{tr}_{po}") for tr, po in names],
    )

    def total(prefix: str):
        return sum((F.col(f"{prefix}_{tr}_{po}") for tr, po in names[1:]), F.col(f"{prefix}_0_0"))

    full = F.least(*[F.col(f"n_{tr}_{po}") for tr, po in names]) > 0
    inverse = sum((F.try_divide(F.lit(1.0), F.col(f"n_{tr}_{po}")) for tr, po in names), F.lit(0.0))
    spread = sum((F.try_divide(F.col(f"m2_{tr}_{po}"), F.col(f"n_{tr}_{po}") * F.col(f"n_{tr}_{po}"))
                  for tr, po in names), F.lit(0.0))
    usable = full & (F.col("n_obs") > 4)
    dof = F.col("n_obs") - 4
    att = (F.col("mean_1_1") - F.col("mean_1_0")) - (F.col("mean_0_1") - F.col("mean_0_0"))
    return (
        wide.withColumn("n_obs", total("n"))
        .withColumn("identified", full)
        .withColumn("alpha", F.col("mean_0_0"))
        .withColumn("beta_treated", F.col("mean_1_0") - F.col("mean_0_0"))
        .withColumn("beta_post", F.col("mean_0_1") - F.col("mean_0_0"))
        .withColumn("att", att)
        .withColumn("naive_did", F.col("att"))
        .withColumn("att_se", F.when(usable, F.sqrt(total("m2") / dof * inverse)))
        .withColumn("att_se_hc1", F.when(usable, F.sqrt(F.col("n_obs") / dof * spread)))
        .withColumn("att_t", F.try_divide(F.col("att"), F.col("att_se")))
        .withColumn("att_ci_low", F.col("att") - F.lit(1.96) * F.col("att_se"))
        .withColumn("att_ci_high", F.col("att") + F.lit(1.96) * F.col("att_se"))
    )


def with_placebo(moments: DataFrame) -> DataFrame:
    """Every moment row under test 'main' and pre-period rows again under test 'placebo'.

    The placebo's post flag splits the pre-period half the pre window after the first date present. Doubling the small
    moment table lets one pass over the data serve both tests.
    """
    first = F.min(F.when(F.col("post") == 0, F.col("date"))).over(Window.partitionBy(*KEYS))
    half = F.floor(F.col("pre_weeks") / F.lit(2)).cast("int") * 7
    pseudo = F.when(F.col("post") == 0, (F.col("date") >= F.date_add(first, half)).cast("int"))
    tests = F.array(F.struct(F.lit("main").alias("test"), F.col("post").alias("post")),
                    F.struct(F.lit("placebo").alias("test"), pseudo.alias("post")))
    kept = [c for c in moments.columns if c != "post"]
    doubled = moments.withColumn("_tests", tests)
    return doubled.select(*kept, F.inline("_tests")).filter(F.col("post").isNotNull())


def fit_tests(moments: DataFrame) -> DataFrame:
    """Estimates of the main test with parallel_trends_t and parallel_trends_n of its placebo."""
    keys = [*KEYS, "test"]
    fitted = from_cells(cell_moments(with_placebo(moments), keys), keys)
    floor = F.greatest(F.coalesce(F.col("att_se"), F.lit(1e-10)), F.lit(1e-10))
    placebo, group = F.col("test") == "placebo", Window.partitionBy(*KEYS)
    return (fitted.withColumn("parallel_trends_t", F.max(F.when(placebo, F.col("att") / floor)).over(group))
            .withColumn("parallel_trends_n", F.max(F.when(placebo, F.col("n_obs"))).over(group))
            .filter(F.col("test") == "main").drop("test"))


def estimate(panel: DataFrame, specs: DataFrame, outcomes: list[str], se_type: str = "classical",
             p_values: bool = True) -> DataFrame:
    """One row per experiment and outcome. se_type 'hc1' bases t, interval and p on the robust error."""
    out = fit_tests(moments(panel, specs, outcomes))
    if se_type == "hc1":
        out = (out.withColumn("att_se", F.col("att_se_hc1"))
               .withColumn("att_t", F.try_divide(F.col("att"), F.col("att_se")))
               .withColumn("att_ci_low", F.col("att") - F.lit(1.96) * F.col("att_se"))
               .withColumn("att_ci_high", F.col("att") + F.lit(1.96) * F.col("att_se")))
    if not p_values:
        return out
    out = (out.withColumn("att_p", student_t_p(F.col("att_t"), (F.col("n_obs") - 4).cast("double")))
           .withColumn("parallel_trends_p", student_t_p(
               F.col("parallel_trends_t"), (F.col("parallel_trends_n") - 4).cast("double"))))
    return (out.withColumn("significant", F.coalesce(F.col("att_p") < 0.05, F.lit(False)))
            .withColumn("parallel_ok", F.coalesce(F.col("parallel_trends_p") > 0.05, F.lit(False))))


def group_means(estimates: DataFrame) -> DataFrame:
    """Cell means as a map keyed '<treated>_<post>'."""
    keys = [f"{tr}_{po}" for tr in (0, 1) for po in (0, 1)]
    pairs = [x for k in keys for x in (F.lit(k), F.col(f"mean_{k}"))]
    return estimates.withColumn("group_means", F.create_map(*pairs))


def coefficient_rows(estimates: DataFrame) -> DataFrame:
    """Coefficient table as long rows: intercept, treated, post and the treatment effect."""
    null = F.lit(None).cast("double")
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("coefficient"), F.col(c).alias("estimate"),
                 (F.col("att_se") if c == "att" else null).alias("se"),
                 (F.col("att_t") if c == "att" else null).alias("t"))
        for i, (label, c) in enumerate([("intercept", "alpha"), ("treated", "beta_treated"), ("post", "beta_post"),
                                        ("att", "att")])])
    return estimates.select(*KEYS, F.inline(rows))
