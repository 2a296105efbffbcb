"""Readings, prices and billing rows derived from the supplied tables.

Readings are the events that are not purchases, prices are the purchases; users map to nations
(states) and regions. Line items give billing rows over several years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOADED_EVERY = "day"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_zone(frame: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add ``state_code`` and ``us_region`` of ``zone_id``.

    Two joins in a row rather than one with a joined dimension: Spark then sees the true file
    size of each side and builds on the small one.
    """
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("zone_id"),
        F.col("n_name").alias("state_code"),
        "n_regionkey",
    )
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("us_region")
    )
    return frame.join(nation, "zone_id").join(region, "n_regionkey").drop("n_regionkey")


def _exact(units: Column, step: str, kind: str) -> Column:
    return (units.cast("decimal(12,0)") * F.lit(step).cast("decimal(4,3)")).cast(kind)


def _loaded(moment: Column) -> Column:
    """Daily loads: everything of a day arrives at the next midnight."""
    return F.date_trunc(LOADED_EVERY, moment) + F.expr("interval 1 day")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumns(
        {
            "zone_id": F.col("user_id") % 25,
            "moment": F.col("ts").cast("timestamp"),
            "meter_id": F.concat(F.lit("meter-"), F.lpad(F.col("user_id").cast("string"), 12, "0")),
        }
    )
    return with_zone(events, spark, folder)


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the warehouse table of meter readings."""
    k = F.get_json_object("props", "$.k").cast("int")
    return _events(spark, folder).filter("event_type <> 'purchase'").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit("1.0").alias("schema_version"),
        "meter_id",
        "us_region",
        "state_code",
        F.col("moment").alias("event_time"),
        F.col("value").cast("decimal(12,5)").alias("energy_kwh"),
        _exact(2000 + k * 5, "0.100", "decimal(8,2)").alias("voltage_v"),
        _exact(F.col("event_id") % 5000, "0.001", "decimal(8,3)").alias("current_a"),
        _exact(85 + k % 16, "0.010", "decimal(5,3)").alias("power_factor"),
        F.lit("events").alias("bucket_name"),
        F.col("event_type").alias("object_key"),
        F.lit(0).alias("source_line_number"),
        F.concat(F.lit("events/"), F.col("event_type")).alias("record_source"),
        _loaded(F.col("moment")).alias("load_datetime"),
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the warehouse table of prices."""
    price = F.round(F.col("value").cast("decimal(12,2)") * F.lit("0.001").cast("decimal(4,3)"), 4)
    return _events(spark, folder).filter("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("price_id"),
        F.lit("1.0").alias("schema_version"),
        "us_region",
        "state_code",
        F.lit("USD").alias("currency_code"),
        F.col("moment").alias("effective_from"),
        price.cast("decimal(10,4)").alias("price_per_kwh"),
        F.lit("events/purchase").alias("source_system"),
        _loaded(F.col("moment")).alias("load_datetime"),
    )


def billing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Shipped line items as priced readings of customers, 1995 to 2001."""
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("long").alias("zone_id")
    )
    exact = lambda name, kind: F.col(name).cast(kind)
    revenue = exact("l_extendedprice", "decimal(12,2)") * (
        F.lit(1).cast("decimal(3,2)") - exact("l_discount", "decimal(3,2)")
    )
    # The lines, which are most, are shuffled once: customers meet the orders first.
    owners = orders.select("o_orderkey", "o_custkey").join(customers, F.expr("o_custkey = c_custkey"))
    shipped = items.join(owners, F.expr("l_orderkey = o_orderkey"))
    return with_zone(shipped, spark, folder).select(
        F.concat(F.lit("meter-"), F.lpad(F.col("o_custkey").cast("string"), 12, "0")).alias(
            "meter_id"
        ),
        "us_region",
        "state_code",
        F.lit("USD").alias("currency_code"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        exact("l_quantity", "decimal(12,5)").alias("energy_kwh"),
        F.round(revenue, 4).alias("usage_revenue"),
    )


def customer_states(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as load history of customers: a real sequence of changing payloads."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("load_datetime"),
        F.lit("orders").alias("record_source"),
    )
