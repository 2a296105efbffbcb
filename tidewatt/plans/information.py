"""Current state rebuilt from the vault: readings, effective prices, priced readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.arithmetic import rounded
from tidewatt.operators.asof import asof_join, effective_intervals
from tidewatt.operators.vault import LDTS, current_rows

READING_COLUMNS = (
    "event_id", "meter_id", "us_region", "state_code", "event_time", "energy_kwh", "voltage_v",
    "current_a", "power_factor", "schema_version", "load_datetime",
)


def int_meter_readings(vault: Mapping[str, DataFrame]) -> DataFrame:
    """One row per reading with the meter's latest details.

    The three tables as large as the readings meet on the reading key first, so they share one
    partitioning; the meter side is joined once, as one table.
    """
    metrics = current_rows(
        vault["sat_reading_metrics"], "hk_reading_h", ["event_time", "hd_reading_metrics_s"]
    ).select(
        "hk_reading_h", "event_time", "energy_kwh", "voltage_v", "current_a", "power_factor",
        F.col(LDTS).alias("load_datetime"),
    )
    details = current_rows(vault["sat_meter_details"], "hk_meter_h", ["hd_meter_details_s"]).select(
        "hk_meter_h", "schema_version", "us_region", "state_code"
    )
    meters = vault["hub_meter"].select("hk_meter_h", "meter_id").join(details, "hk_meter_h")
    readings = (
        vault["hub_reading"]
        .select("hk_reading_h", "event_id")
        .filter(F.col("event_id").isNotNull())
    )
    return (
        vault["link_meter_reading"]
        .select("hk_reading_h", "hk_meter_h")
        .join(readings, "hk_reading_h")
        .join(metrics, "hk_reading_h")
        .join(meters, "hk_meter_h")
        .select(*READING_COLUMNS)
    )


def int_electricity_prices(vault: Mapping[str, DataFrame]) -> DataFrame:
    """Prices with the interval in which each is in force; the newest stays open."""
    details = current_rows(
        vault["sat_price_details"], "hk_price_h", ["effective_from", "hd_price_details_s"]
    ).select("hk_price_h", "effective_from", "price_per_kwh", F.col(LDTS).alias("__price_ldts"))
    zone_details = current_rows(
        vault["sat_pricing_zone_details"], "hk_pricing_zone_h", ["hd_pricing_zone_details_s"]
    ).select("hk_pricing_zone_h", "us_region", "currency_code", F.col(LDTS).alias("__zone_ldts"))
    zones = (
        vault["hub_pricing_zone"]
        .select("hk_pricing_zone_h", "state_code")
        .join(zone_details, "hk_pricing_zone_h")
    )
    prices = (
        vault["link_pricing_zone_price"]
        .select("hk_price_h", "hk_pricing_zone_h")
        .join(vault["hub_price"].select("hk_price_h", "price_id"), "hk_price_h")
        .join(details, "hk_price_h")
        .join(zones, "hk_pricing_zone_h")
        .select(
            "price_id", "state_code", "us_region", "currency_code", "effective_from",
            "price_per_kwh",
            F.greatest("__price_ldts", "__zone_ldts").alias("load_datetime"),
        )
    )
    return effective_intervals(prices, ["state_code"], "effective_from", "effective_to").select(
        "price_id", "state_code", "us_region", "currency_code", "effective_from", "effective_to",
        "price_per_kwh", "load_datetime",
    )


def int_meter_readings_priced(
    readings: DataFrame,
    prices: DataFrame,
    strategy: str = "bucket",
) -> DataFrame:
    """Readings with the price in force in their state at their time.

    The region is compared on that price only: when it differs the reading stays unpriced and is
    dropped here, and ``readings_without_price`` reports it.
    """
    tariffs = prices.select(
        "state_code", "us_region", "price_id", "currency_code",
        F.col("effective_from").alias("price_effective_from"), "effective_to", "price_per_kwh",
        F.col("load_datetime").alias("__price_loaded"),
    )
    joined = asof_join(
        readings,
        tariffs,
        by=["state_code"],
        also=["us_region"],
        left_ts="event_time",
        valid_from="price_effective_from",
        valid_to="effective_to",
        strategy=strategy,
    )
    revenue = rounded(F.col("energy_kwh") * F.col("price_per_kwh"), 4)
    return joined.select(
        "event_id", "meter_id", "us_region", "state_code", "event_time", "energy_kwh",
        "voltage_v", "current_a", "power_factor", "schema_version", "price_id", "currency_code",
        "price_effective_from", "price_per_kwh",
        revenue.alias("usage_revenue"),
        F.greatest("load_datetime", "__price_loaded").alias("load_datetime"),
    )


def readings_without_price(readings: DataFrame, priced: DataFrame) -> DataFrame:
    return readings.join(priced.select("event_id"), "event_id", "left_anti").select(
        "event_id", "state_code", "event_time"
    )
