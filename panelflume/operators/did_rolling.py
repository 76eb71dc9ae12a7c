"""Difference-in-differences at every date of a calendar grid, and the dates at which something happened.

Instead of one experiment per date, which would copy each day into every window it lies in, days are reduced to one row per
arm and date, and each date of the grid reads the windows before and after it with two range frames.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelflume.operators import did

MONDAY = "1970-01-05"


def arm_days(days: DataFrame, specs: DataFrame) -> DataFrame:
    """(experiment, outcome, treated, date, n, mean, m2) of rows (route, date, _moments), see did.day_moments."""
    sides = F.concat(F.transform("treatment_routes", lambda r: F.struct(r.alias("route"), F.lit(1).alias("treated"))),
                     F.transform("control_routes", lambda r: F.struct(r.alias("route"), F.lit(0).alias("treated"))))
    arms = specs.select("experiment", F.inline(sides))
    met = days.join(arms, "route").select("experiment", "treated", "date", F.inline("_moments")).filter(F.col("n") > 0)
    return did.pooled(met, ["experiment", "outcome", "treated", "date"])


def rolling(days: DataFrame, specs: DataFrame, pre_weeks: int, post_weeks: int, every: int = 1) -> DataFrame:
    """did.from_cells() for every experiment, outcome and treatment_date on a Monday grid of `every` weeks.

    days: (route, date, _moments); specs: (experiment, treatment_routes, control_routes). Only dates count whose whole
    window, from pre_weeks before to post_weeks after, lies within the days of the experiment; a window without rows in
    some cell has no standard error. Sums are taken about the mean of the arm, so a large mean costs no digits.
    A series is an arm's days: its length is bounded by the calendar, whatever the number of rows or routes.
    """
    rows = arm_days(days, specs).withColumn("day", F.datediff("date", F.lit(MONDAY).cast("date")))
    arm = ["experiment", "outcome", "treated"]
    whole = Window.partitionBy(*arm)
    centred = rows.withColumn("centre", F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole))
    gap = F.col("mean") - F.col("centre")
    sums = centred.select(*arm, "day", "centre", F.lit(False).alias("probe"), "n", (F.col("n") * gap).alias("s1"),
                          (F.col("m2") + F.col("n") * gap * gap).alias("s2"))
    step = 7 * every
    span = rows.groupBy("experiment").agg(F.min("day").alias("low"), F.max("day").alias("high"), F.collect_set("outcome").alias("outcomes"))
    first = (F.ceil((F.col("low") + 7 * pre_weeks) / F.lit(step)) * step).cast("int")
    last = F.col("high") - 7 * post_weeks
    dates = span.filter(first <= last).select("experiment", "outcomes", F.explode(F.sequence(first, last, F.lit(step))).alias("day"))
    grid = dates.select("experiment", F.explode("outcomes").alias("outcome"), "day")
    probes = grid.select("experiment", "outcome", F.explode(F.array(F.lit(0), F.lit(1))).alias("treated"), "day", F.lit(None).cast("double").alias("centre"),
                         F.lit(True).alias("probe"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s1"), F.lit(0.0).alias("s2"))
    along = Window.partitionBy(*arm).orderBy("day")
    frames = [(0, along.rangeBetween(-7 * pre_weeks, -1)), (1, along.rangeBetween(0, 7 * post_weeks))]
    cells = F.array(*[F.struct(F.lit(post).alias("post"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n"), F.sum("s1").over(w).alias("s1"),
                               F.sum("s2").over(w).alias("s2"), F.max("centre").over(whole).alias("centre")) for post, w in frames])
    seen = sums.unionByName(probes).withColumn("cells", cells).filter("probe").select(*arm, "day", F.inline("cells")).filter(F.col("n") > 0)
    shift = F.col("s1") / F.col("n")
    moments = seen.select("experiment", "outcome", "treated", F.date_add(F.lit(MONDAY).cast("date"), F.col("day")).alias("treatment_date"), "post",
                          "n", (F.col("centre") + shift).alias("mean"), F.greatest(F.col("s2") - F.col("s1") * shift, F.lit(0.0)).alias("m2"))
    return did.from_cells(moments, ["experiment", "outcome", "treatment_date"])


def events(estimates: DataFrame, least_t: float = 3.0, apart_weeks: int = 26) -> DataFrame:
    """Rows of rolling() at which the effect stands out: |att_t| of at least least_t, and the largest within apart_weeks on
    either side (the earliest of equals)."""
    size, day = F.abs("att_t"), F.datediff("treatment_date", F.lit(MONDAY).cast("date"))
    near = Window.partitionBy("experiment", "outcome").orderBy(day).rangeBetween(-7 * apart_weeks, 7 * apart_weeks)
    earlier = Window.partitionBy("experiment", "outcome").orderBy(day).rangeBetween(-7 * apart_weeks, -1)
    top = size.eqNullSafe(F.max(size).over(near)) & ~F.coalesce(F.max(size).over(earlier) >= size, F.lit(False))
    return estimates.withColumn("event", (size >= least_t) & top).filter("event").drop("event")
