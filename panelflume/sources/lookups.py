"""Small look-up tables as SQL VALUES.

A VALUES table is a LocalRelation, so Catalyst knows its exact size and decides on a broadcast by that size.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelflume import fixed_values as fv

SHAPES = {
    "school_holidays": [("start_date", "date"), ("end_date", "date")],
    "public_holidays": [("day", "date")],
    "events": [("event_id", "string"), ("event_date", "date"), ("city", "string"), ("peak_mult", "double"),
               ("lead_weeks", "int")],
    "regimes": [("from_date", "date"), ("to_date", "date"), ("v0", "double"), ("v1", "double")],
    "macro": [("year", "int"), ("rate", "double"), ("cpi", "double"), ("fuel", "double")],
    "competition_rules": [("year", "int"), ("competitor", "string"), ("leisure_above", "double"), ("factor", "double")],
    "daily_flights": [("route", "string"), ("flights", "int")],
    "routes": [("route", "string"), ("route_desc", "string"), ("base_pax_weekly", "int"), ("avg_yield", "int"),
               ("distance_km", "int"), ("competitors", "array<string>"), ("comp_capacity_share", "double"),
               ("business_mix", "double"), ("avg_load_factor", "double"), ("trend_pa", "double")],
}
DEFAULTS = {
    "school_holidays": fv.SCHOOL_HOLIDAYS,
    "public_holidays": [(d,) for d in fv.PUBLIC_HOLIDAYS],
    "events": fv.EVENTS,
    "regimes": fv.REGIMES,
    "macro": fv.MACRO,
    "competition_rules": fv.COMPETITION_RULES,
    "daily_flights": fv.DAILY_FLIGHTS,
    "routes": fv.ROUTES,
}


def _literal(value, kind: str, array_word: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind.startswith("array"):
        return f"{array_word}({', '.join(_literal(v, 'string', '') for v in value)})"
    if kind == "date":
        return f"DATE '{value}'"
    if kind == "string":
        return "'" + str(value).replace("'", "''") + "'"
    return f"CAST({value} AS {kind})"


def values_sql(shape: list[tuple[str, str]], rows: list[tuple], alias: str = "t", array_word: str = "array") -> str:
    """`(VALUES ...) AS alias(columns)`, readable by Spark and by any ANSI engine."""
    body = ", ".join("(" + ", ".join(_literal(v, kind, array_word) for v, (_, kind) in zip(row, shape)) + ")"
                     for row in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(name for name, _ in shape)})"


def values_table(spark: SparkSession, shape: list[tuple[str, str]], rows: list[tuple]) -> DataFrame:
    """Literal rows as a DataFrame in one partition, so that grouping them needs no exchange. Bulk tables come as
    DataFrames of their own."""
    return spark.sql(f"SELECT * FROM {values_sql(shape, rows)}").coalesce(1)


def lookup(spark: SparkSession, name: str, rows: list[tuple] | None = None) -> DataFrame:
    """One of the named look-up tables, with the default rows or the caller's."""
    return values_table(spark, SHAPES[name], DEFAULTS[name] if rows is None else rows)
