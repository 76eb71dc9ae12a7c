"""Calendar, event, macro and entity enrichment.

Interval and distance conditions are rewritten to equality on the day: the small side is expanded to one row per day
it touches, so every join is an equi-join that Catalyst may broadcast (if small) or shuffle (if not), and no panel row
is paired with calendar rows it does not match.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelflume import fixed_values as fv
from panelflume.functions.columns import half_even
from panelflume.sources.lookups import lookup


def school_holidays(df: DataFrame, intervals: DataFrame, time: str = "date") -> DataFrame:
    """school_holiday = 1 if the date lies in any [start_date, end_date]."""
    return _flag(df, _school_days(intervals).distinct().withColumnRenamed("day", time), time, "school_holiday")


def public_holidays(df: DataFrame, holidays: DataFrame, time: str = "date") -> DataFrame:
    """public_holiday = 1 if a holiday falls on the date or the six days after it."""
    return _flag(df, _holiday_weeks(holidays).distinct().withColumnRenamed("day", time), time, "public_holiday")


def _school_days(intervals: DataFrame) -> DataFrame:
    """Days of the intervals; one that ends before it starts has none."""
    return intervals.filter("start_date <= end_date").select(F.explode(F.sequence("start_date", "end_date")).alias("day"))


def _holiday_weeks(holidays: DataFrame) -> DataFrame:
    return holidays.select(F.explode(F.sequence(F.date_sub("day", 6), F.col("day"))).alias("day"))


def _flag(df: DataFrame, days: DataFrame, time: str, name: str) -> DataFrame:
    hit = days.withColumn(name, F.lit(1))
    return df.join(hit, time, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def event_effects(events: DataFrame) -> DataFrame:
    """Event pull per day: (day, effects array<struct<city, effect>>), summed over events of the same city.

    An event reaches from lead_weeks before its date to one week after. An array holds one entry per city active on
    that day.
    """
    days = events.filter("lead_weeks >= -1").withColumn("day", F.explode(F.sequence(
        F.date_sub("event_date", F.col("lead_weeks") * 7), F.date_add("event_date", 7))))
    weeks = F.datediff("event_date", "day") / F.lit(7.0)
    sigma = F.greatest(F.col("lead_weeks") / F.lit(2.5), F.lit(0.5))
    bell = F.exp(F.lit(-0.5) * F.pow(weeks / sigma, F.lit(2.0)))
    per_city = days.groupBy("day", "city").agg(F.sum((F.col("peak_mult") - F.lit(1.0)) * bell).alias("effect"))
    return per_city.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("city", "effect"))).alias("effects"))


def event_multiplier(df: DataFrame, events: DataFrame, entity: str = "route", time: str = "date") -> DataFrame:
    """1 plus the effects of all events whose city occurs in the entity name."""
    effects = event_effects(events).withColumnRenamed("day", time)
    return df.join(effects, time, "left").withColumn(
        "event_multiplier", F.lit(1.0) + F.coalesce(_effect_sum(F.col(entity)), F.lit(0.0))).drop("effects")


def _effect_sum(entity: Column) -> Column:
    mine = F.filter("effects", lambda e: entity.contains(e["city"]))
    return F.aggregate(mine, F.lit(0.0), lambda acc, e: acc + e["effect"])


def regime_factor(df: DataFrame, regimes: DataFrame, time: str = "date", name: str = "covid_factor") -> DataFrame:
    """Linear interpolation inside [from_date, to_date), 1 outside all regimes."""
    factors = regime_days(regimes).select(F.col("day").alias(time), F.col("factor").alias(name))
    return df.join(factors, time, "left").withColumn(name, F.coalesce(F.col(name), F.lit(1.0)))


def regime_days(regimes: DataFrame) -> DataFrame:
    days = regimes.filter("from_date < to_date").withColumn("day", F.explode(F.sequence("from_date", F.date_sub("to_date", 1))))
    share = F.datediff("day", "from_date") / F.datediff("to_date", "from_date")
    return days.select("day", (F.col("v0") + (F.col("v1") - F.col("v0")) * share).alias("factor"))


def macro(df: DataFrame, annual: DataFrame) -> DataFrame:
    """rba_cash_rate, inflation and macro_fuel by year, with defaults for years not listed."""
    renamed = annual.select("year", F.col("rate").alias("rba_cash_rate"), F.col("cpi").alias("inflation"),
                            F.col("fuel").alias("macro_fuel"))
    return df.join(renamed, "year", "left").fillna(
        {"rba_cash_rate": fv.DEFAULT_RATE, "inflation": fv.DEFAULT_CPI, "macro_fuel": fv.DEFAULT_FUEL})


def price_index(years: DataFrame, annual: DataFrame, base_year: int = fv.BASE_YEAR) -> DataFrame:
    """(year, cpi_index): product of 1+growth from base_year through each distinct year; 1 before base_year."""
    spans = years.select("year").distinct().withColumn(
        "_y", F.explode(F.when(F.col("year") >= base_year, F.sequence(F.lit(base_year), F.col("year")))
                        .otherwise(F.array(F.lit(None).cast("int")))))
    rates = annual.select(F.col("year").alias("_y"), "cpi")
    step = F.when(F.col("_y").isNull(), 0.0).otherwise(F.coalesce(F.col("cpi"), F.lit(fv.DEFAULT_CPI)))
    return (spans.join(rates, "_y", "left").groupBy("year")
            .agg(F.exp(F.sum(F.log1p(step))).alias("cpi_index")))


def entity_attributes(df: DataFrame, dimension: DataFrame, entity: str = "route") -> DataFrame:
    return df.join(dimension, entity, "left")


def competition_rules(df: DataFrame, rules: DataFrame, name: str = "competition_index") -> DataFrame:
    """Multiply the index by the factor of every rule that holds for the row's year, competitors and business_mix."""
    per_year = rules.groupBy("year").agg(
        F.sort_array(F.collect_list(F.struct("factor", "competitor", "leisure_above"))).alias("_rules"))
    applies = F.filter("_rules", lambda r: (
        (r["competitor"].isNull() | F.array_contains(F.col("competitors"), r["competitor"]))
        & (r["leisure_above"].isNull() | (F.lit(1.0) - F.col("business_mix") > r["leisure_above"]))))
    factor = F.aggregate(applies, F.lit(1.0), lambda acc, r: acc * r["factor"])
    return df.join(per_year, "year", "left").withColumn(
        name, F.col(name) * F.coalesce(factor, F.lit(1.0))).drop("_rules")


def densify(df: DataFrame, step_days: int = 7, fill: dict | None = None, entity: str = "route",
            time: str = "date") -> DataFrame:
    """One row per period between each entity's first and last date; `fill` gives values for the added rows.

    Every row brings forth the periods missing before the next row, so the data is read once and joined with nothing.
    """
    following = F.lead(time).over(Window.partitionBy(entity).orderBy(time))
    until = F.greatest(F.col(time), F.coalesce(F.date_sub(following, step_days), F.col(time)))
    dates = F.sequence(F.col(time), until, F.make_dt_interval(F.lit(step_days)))
    values = [c for c in df.columns if c not in (entity, time)]
    spread = df.withColumn("_dates", dates).select(entity, *values, F.posexplode("_dates").alias("_nth", "_date"))
    out = spread.select(entity, F.col("_date").alias(time), *[F.when(F.col("_nth") == 0, F.col(c)).alias(c) for c in values])
    return out.fillna(fill) if fill else out


def day_dimension(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per day that any calendar table touches: school_holiday, public_holiday, effects, covid_factor."""
    parts = [
        _school_days(tables["school_holidays"]).withColumn("school_holiday", F.lit(1)),
        _holiday_weeks(tables["public_holidays"]).withColumn("public_holiday", F.lit(1)),
        event_effects(tables["events"]),
        regime_days(tables["regimes"]).withColumnRenamed("factor", "covid_factor"),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy("day").agg(
        F.max("school_holiday").alias("school_holiday"), F.max("public_holiday").alias("public_holiday"),
        F.first("effects", ignorenulls=True).alias("effects"), F.max("covid_factor").alias("covid_factor"))


FIRST_YEAR, LAST_YEAR = 1900, 2100


def last_year(annual: DataFrame) -> DataFrame:
    """One row: the last year of the year table, which reaches past LAST_YEAR where the macro table does."""
    return annual.agg(F.greatest(F.coalesce(F.max("year"), F.lit(LAST_YEAR)), F.lit(LAST_YEAR)).alias("year"))


def year_dimension(annual: DataFrame, base_year: int) -> DataFrame:
    """One row per calendar year, FIRST_YEAR to LAST_YEAR and on to any listed year, with macro columns, defaults filled in, and
    the price index."""
    first = F.least(F.coalesce(F.min("year"), F.lit(FIRST_YEAR)), F.lit(FIRST_YEAR))
    until = F.greatest(F.coalesce(F.max("year"), F.lit(LAST_YEAR)), F.lit(LAST_YEAR))
    years = annual.agg(F.explode(F.sequence(first, until)).alias("year")).select(F.col("year").cast("int").alias("year"))
    return macro(price_index(years, annual, base_year), annual)


def calendar(df: DataFrame, tables: dict[str, DataFrame], base_year: int = fv.BASE_YEAR) -> DataFrame:
    """All calendar, event and macro columns of the panel, rounded as stored, from one join by day and one by year.

    Years outside the year table get the defaults; their price index grows by the default rate beyond the table's end.
    """
    days = day_dimension(tables).withColumnRenamed("day", "date")
    listed = tables["macro"]
    out = df.join(days, "date", "left").join(year_dimension(listed, base_year), "year", "left")
    until = F.greatest(last_year(listed).scalar(), F.lit(base_year - 1))
    end = price_index(last_year(listed), listed, base_year).select("cpi_index").scalar()
    beyond = F.when(F.col("year") > until, end * F.pow(F.lit(1.0 + fv.DEFAULT_CPI), F.col("year") - until)).otherwise(F.lit(1.0))
    total = F.lit(1.0) + F.coalesce(_effect_sum(F.col("route")), F.lit(0.0))
    return out.withColumns({
        "school_holiday": F.coalesce("school_holiday", F.lit(0)),
        "public_holiday": F.coalesce("public_holiday", F.lit(0)),
        "event_multiplier": half_even(total, 4),
        "covid_factor": half_even(F.coalesce("covid_factor", F.lit(1.0)), 4),
        "rba_cash_rate": F.coalesce("rba_cash_rate", F.lit(fv.DEFAULT_RATE)),
        "inflation": F.coalesce("inflation", F.lit(fv.DEFAULT_CPI)),
        "macro_fuel": F.coalesce("macro_fuel", F.lit(fv.DEFAULT_FUEL)),
        "cpi_index": half_even(F.coalesce("cpi_index", beyond), 4),
    }).drop("effects")


def default_tables(spark) -> dict[str, DataFrame]:
    return {name: lookup(spark, name) for name in ("school_holidays", "public_holidays", "events", "regimes", "macro")}
