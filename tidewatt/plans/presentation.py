"""Dimensions, facts and periodic marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.arithmetic import rounded_ratio, scaled
from tidewatt.functions.calendar import GRAIN_NAMES, date_key, day_part, iso_day_of_week
from tidewatt.functions.hashing import surrogate_key
from tidewatt.operators.calendar import SPINE_END, SPINE_START, time_spine
from tidewatt.operators.rollup import PERIOD, periodic_totals

# Fixed value: modelled tax.
TAX_RATE, GROSS_RATE = "0.05", "1.05"


def dim_date(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    day = F.col("date_day")
    weekday = iso_day_of_week(day)
    return time_spine(spark, "day", start, end).select(
        date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        weekday.alias("iso_day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    )


def with_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """A fact with the attributes of its ``date_key``; rows outside the calendar keep their place
    with empty attributes instead of vanishing."""
    return fact.join(dates, "date_key", "left")


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("time_key")
    day = time_spine(spark, "hour", SPINE_START, SPINE_START.replace("01-01", "01-02"))
    return day.select(F.hour("date_hour").alias("time_key")).select(
        "time_key",
        F.format_string("%02d:00:00", hour).alias("hour_start"),
        F.format_string("%02d:00", hour).alias("hour_label"),
        day_part(hour).alias("day_part"),
    )


def dim_meter(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("meter_id", "us_region", "state_code")
        .agg(
            F.min("event_time").alias("first_reading_at"),
            F.max("event_time").alias("latest_reading_at"),
        )
        .select(
            surrogate_key("meter_id").alias("meter_key"), "meter_id", "us_region", "state_code",
            "first_reading_at", "latest_reading_at",
        )
    )


def dim_pricing_zone(prices: DataFrame) -> DataFrame:
    return (
        prices.groupBy("state_code")
        .agg(F.min("us_region").alias("us_region"), F.min("currency_code").alias("currency_code"))
        .select(
            surrogate_key("state_code").alias("pricing_zone_key"), "us_region", "state_code",
            "currency_code",
        )
    )


def fact_meter_reading(readings: DataFrame) -> DataFrame:
    moment = F.col("event_time")
    return readings.select(
        surrogate_key("event_id").alias("reading_key"),
        "event_id",
        surrogate_key("meter_id").alias("meter_key"),
        date_key(moment).alias("date_key"),
        F.hour(moment).alias("time_key"),
        surrogate_key("state_code").alias("pricing_zone_key"),
        "event_time", "energy_kwh", "voltage_v", "current_a", "power_factor", "load_datetime",
    )


def fact_hourly_energy_billing(priced: DataFrame) -> DataFrame:
    """Hourly totals per meter and state. Keys are hashed once per group, after the sums."""
    hourly = priced.groupBy(
        "meter_id", "state_code", F.date_trunc("hour", "event_time").alias("reading_hour")
    ).agg(
        F.sum("energy_kwh").alias("energy_kwh"),
        F.sum("usage_revenue").alias("usage_revenue"),
        F.count(F.lit(1)).alias("reading_count"),
    )
    hour = F.col("reading_hour")
    return hourly.select(
        surrogate_key("meter_id").alias("meter_key"),
        date_key(hour).alias("date_key"),
        F.hour(hour).alias("time_key"),
        surrogate_key("state_code").alias("pricing_zone_key"),
        "reading_hour",
        "energy_kwh",
        rounded_ratio(F.col("usage_revenue"), F.col("energy_kwh"), 6).alias("price_per_kwh"),
        "usage_revenue",
        "reading_count",
    )


def mart_meter_operations(
    fact: DataFrame, meters: DataFrame, grains: Sequence[str] = GRAIN_NAMES
) -> DataFrame:
    """Operational totals per grain, period and meter. ``fact`` is fact_meter_reading."""
    totals = periodic_totals(
        fact,
        "event_time",
        ["meter_key"],
        {"energy_kwh": "energy_kwh", "voltage_sum": "voltage_v",
         "power_factor_sum": "power_factor"},
        count="reading_count",
        grains=grains,
    )
    dims = meters.select("meter_key", "meter_id", "us_region", "state_code")
    return totals.join(dims, "meter_key").select(
        *PERIOD, "meter_id", "us_region", "state_code",
        "energy_kwh", "voltage_sum", "power_factor_sum", "reading_count",
    )


def mart_executive_billing(
    fact: DataFrame,
    meters: DataFrame,
    zones: DataFrame,
    grains: Sequence[str] = GRAIN_NAMES,
    data_start: Column | None = None,
) -> DataFrame:
    """Billing totals per grain, period, meter and currency. ``fact`` is the hourly fact.

    The zone is looked up before the totals because its currency is a group column; rows without
    one still count for the first period and are dropped afterwards. The meter is looked up on
    the totals, which are fewer. The hours of a meter are few, so the fact is dealt by meter once;
    all grains and the look-up stay in that partitioning. Store ``fact`` first when it is expensive:
    it is read twice, unless ``data_start`` gives its first hour.
    """
    zone = zones.select("pricing_zone_key", "currency_code", F.lit(True).alias("__zoned"))
    totals = periodic_totals(
        fact.join(zone, "pricing_zone_key", "left")
        .select("meter_key", "currency_code", "__zoned", "reading_hour", "energy_kwh", "usage_revenue")
        .repartition("meter_key"),
        "reading_hour",
        ["meter_key", "currency_code", "__zoned"],
        {"energy_kwh": "energy_kwh", "net_revenue": "usage_revenue"},
        grains=grains,
        data_start=data_start,
    ).filter("__zoned")
    # A hash table of a task's meters: the totals, several times the fact, are not sorted to meet them.
    dims = meters.select("meter_key", "meter_id", "us_region", "state_code").hint("shuffle_hash")
    net, energy = F.col("net_revenue"), F.col("energy_kwh")
    return totals.join(dims, "meter_key").select(
        *PERIOD, "meter_id", "us_region", "state_code", "currency_code",
        "energy_kwh", "net_revenue",
        scaled(net, TAX_RATE, 4).alias("tax_amount"),
        scaled(net, GROSS_RATE, 4).alias("gross_billed"),
        rounded_ratio(net, energy, 4).alias("realized_price_per_kwh"),
        net.alias("revenue_per_meter"),
    )
