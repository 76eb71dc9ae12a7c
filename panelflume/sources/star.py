"""The panel: one row per entity and week, derived from the order star schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelflume.functions.columns import iso_date

PANEL_SCHEMA = (
    "route string, date date, pax bigint, revenue double, yield_aud double, load_factor double, "
    "competition_index double, fuel_index double, business_mix double, week_of_year int, year int, month int, "
    "quarter int"
)
GRAINS = {"region": ["r_name"], "nation": ["n_name"], "nation_brand": ["n_name", "p_brand"]}


# Declared schemas spare the footer-reading job that inference costs per table.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(lineitem: DataFrame, *keys: str) -> DataFrame:
    """Line measures per order: units, net amount in 1e-4 currency units, discounts and taxes in percent points.

    Amounts are counted in whole units of their last decimal, so sums are exact and do not depend on the partitioning;
    the net amount is summed as a decimal, which has room for any number of rows. The aggregate combines on the map
    side and leaves the data hashed by order, as the join with orders needs it.
    """
    cents, percent = F.rint(F.col("l_extendedprice") * 100).cast("long"), F.rint(F.col("l_discount") * 100).cast("long")
    return lineitem.groupBy("l_orderkey", *keys).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("units"),
        F.sum((cents * (F.lit(100) - percent)).cast("decimal(18,0)")).alias("net"),
        F.sum(percent).alias("discounts"),
        F.sum(F.rint(F.col("l_tax") * 100).cast("long")).alias("taxes"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def panel(spark: SparkSession, sf_dir: str, grain: str = "region", start: str | None = None,
          end: str | None = None, entities: list[str] | None = None) -> DataFrame:
    """Weekly panel in PANEL_SCHEMA, of all orders or of those in [start, end).

    start and end are Mondays; they reach the orders scan as pushed filters. entities restricts the region or nation
    name on the dimension side. With any of these limits, lines are reduced to the located orders before they are summed,
    by a semi join that Spark can turn into a runtime filter on the line scan. No join carries a hint: dimensions are broadcast only if
    their scanned size is below the session's threshold, and a skewed customer or part is split by AQE.
    """
    stamp = F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    if start is not None:
        orders = orders.filter(stamp >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        orders = orders.filter(stamp < F.lit(end).cast("timestamp_ntz"))
    orders = orders.select("o_orderkey", "o_custkey", F.trunc(stamp.cast("date"), "week").alias("date"),
                           F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("priority"))
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    if entities is not None:
        places = places.filter(F.col(GRAINS[grain][0]).isin(entities))
    owners = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name", "r_name")
    located = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"))

    keys = [k for k in GRAINS[grain] if k.startswith("p_")]
    lines = table(spark, sf_dir, "lineitem")
    if (start, end, entities) != (None, None, None):
        lines = lines.join(located.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    if keys:
        parts = table(spark, sf_dir, "part").select("p_partkey", *keys)
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    joined = order_lines(lines, *keys).join(located, F.col("l_orderkey") == F.col("o_orderkey"))

    route = F.concat_ws("|", *GRAINS[grain]) if len(GRAINS[grain]) > 1 else F.col(GRAINS[grain][0])
    weekly = joined.groupBy(route.alias("route"), "date").agg(
        F.sum("units").alias("pax"),
        (F.sum("net").cast("double") / F.lit(10000.0)).alias("revenue"),
        (F.sum("discounts") / F.lit(100.0)).alias("discounts"),
        (F.sum("taxes") / F.lit(100.0)).alias("taxes"),
        F.sum("n_lines").alias("n_lines"),
        F.sum("priority").alias("priority"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    return weekly.select(
        "route", "date", "pax", "revenue",
        (F.col("revenue") / F.col("pax")).alias("yield_aud"),
        (F.col("pax") / F.col("n_lines") / F.lit(50.0)).alias("load_factor"),
        (F.col("discounts") / F.col("n_lines")).alias("competition_index"),
        (F.lit(100.0) * (F.lit(1.0) + F.col("taxes") / F.col("n_lines"))).alias("fuel_index"),
        (F.col("priority") / F.col("n_orders")).alias("business_mix"),
        F.weekofyear("date").alias("week_of_year"), F.year("date").alias("year"),
        F.month("date").alias("month"), F.quarter("date").alias("quarter"),
    )


def with_iso_date(df: DataFrame, name: str = "date") -> DataFrame:
    """Date column as text, for export."""
    return df.withColumn(name, iso_date(F.col(name)))
