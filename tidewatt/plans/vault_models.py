"""Staging, raw vault and business vault of the two source tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewatt.operators.snapshots import AsOf, retained_snapshots, snapshot_calendar
from tidewatt.operators.vault import HashDiff, clean_pit, hub, link, pit, satellite, stage

# Hashed columns, in declared order.
READING_HASHES = {
    "hk_meter_h": ("meter_id",),
    "hk_reading_h": ("event_id",),
    "hk_pricing_zone_h": ("state_code",),
    "hk_meter_reading_l": ("meter_id", "event_id"),
    "hk_meter_pricing_zone_l": ("meter_id", "state_code"),
    "hd_meter_details_s": HashDiff(("schema_version", "us_region", "state_code")),
    "hd_reading_metrics_s": HashDiff(
        ("event_time", "energy_kwh", "voltage_v", "current_a", "power_factor")
    ),
}
PRICE_HASHES = {
    "hk_pricing_zone_h": ("state_code",),
    "hk_price_h": ("price_id",),
    "hk_pricing_zone_price_l": ("state_code", "price_id"),
    "hd_price_details_s": HashDiff(("schema_version", "effective_from", "price_per_kwh")),
    "hd_pricing_zone_details_s": HashDiff(("us_region", "currency_code")),
}


def stage_readings(readings: DataFrame) -> DataFrame:
    return stage(readings, "load_datetime", "record_source", READING_HASHES)


def stage_prices(prices: DataFrame) -> DataFrame:
    return stage(prices, "load_datetime", "source_system", PRICE_HASHES)


@dataclass(frozen=True)
class HubModel:
    source: str
    key: str
    business_keys: tuple[str, ...]
    repeated: bool = False

    def rows(
        self, staged: DataFrame, existing: DataFrame | None, small_batch: bool = False
    ) -> DataFrame:
        return hub(staged, self.key, self.business_keys, existing, small_batch, self.repeated)


@dataclass(frozen=True)
class LinkModel:
    source: str
    key: str
    foreign_keys: tuple[str, ...]
    repeated: bool = False

    def rows(
        self, staged: DataFrame, existing: DataFrame | None, small_batch: bool = False
    ) -> DataFrame:
        return link(staged, self.key, self.foreign_keys, existing, small_batch, self.repeated)


@dataclass(frozen=True)
class SatelliteModel:
    source: str
    key: str
    hashdiff: str
    payload: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    # None where the parent is the primary key of the source table.
    slice_unit: str | None = "month"

    def rows(
        self, staged: DataFrame, existing: DataFrame | None, small_batch: bool = False
    ) -> DataFrame:
        return satellite(
            staged,
            self.key,
            self.hashdiff,
            self.payload,
            existing,
            tie_break=self.tie_break,
            slice_unit=self.slice_unit,
            small_batch=small_batch,
        )


MODELS = {
    "hub_meter": HubModel("readings", "hk_meter_h", ("meter_id",), repeated=True),
    "hub_reading": HubModel("readings", "hk_reading_h", ("event_id",)),
    "hub_pricing_zone": HubModel("prices", "hk_pricing_zone_h", ("state_code",), repeated=True),
    "hub_price": HubModel("prices", "hk_price_h", ("price_id",)),
    "link_meter_reading": LinkModel(
        "readings", "hk_meter_reading_l", ("hk_meter_h", "hk_reading_h")
    ),
    "link_meter_pricing_zone": LinkModel(
        "readings", "hk_meter_pricing_zone_l", ("hk_meter_h", "hk_pricing_zone_h"), repeated=True
    ),
    "link_pricing_zone_price": LinkModel(
        "prices", "hk_pricing_zone_price_l", ("hk_pricing_zone_h", "hk_price_h")
    ),
    # Rows of one load share a load time; the latest event of the load is the state it left.
    "sat_meter_details": SatelliteModel(
        "readings",
        "hk_meter_h",
        "hd_meter_details_s",
        ("schema_version", "us_region", "state_code"),
        ("event_time",),
    ),
    "sat_reading_metrics": SatelliteModel(
        "readings",
        "hk_reading_h",
        "hd_reading_metrics_s",
        ("event_time", "energy_kwh", "voltage_v", "current_a", "power_factor"),
        ("event_time",),
        slice_unit=None,
    ),
    "sat_price_details": SatelliteModel(
        "prices",
        "hk_price_h",
        "hd_price_details_s",
        ("schema_version", "effective_from", "price_per_kwh"),
        ("effective_from",),
        slice_unit=None,
    ),
    "sat_pricing_zone_details": SatelliteModel(
        "prices",
        "hk_pricing_zone_h",
        "hd_pricing_zone_details_s",
        ("us_region", "currency_code"),
        ("effective_from",),
    ),
}

# name -> (hub, hash key, satellite, snapshot trigger, dimension key)
PITS = {
    "pit_meter": ("hub_meter", "hk_meter_h", "sat_meter_details", "is_active", "hk_meter_d"),
    "pit_pricing_zone": (
        "hub_pricing_zone",
        "hk_pricing_zone_h",
        "sat_pricing_zone_details",
        "is_active",
        "hk_pricing_zone_d",
    ),
    "pit_reading": (
        "hub_reading",
        "hk_reading_h",
        "sat_reading_metrics",
        "is_latest",
        "hk_reading_d",
    ),
    "pit_price": ("hub_price", "hk_price_h", "sat_price_details", "is_latest", "hk_price_d"),
}


def load_vault(
    readings: DataFrame | None,
    prices: DataFrame | None,
    existing: Mapping[str, DataFrame] | None = None,
    tables: Iterable[str] = tuple(MODELS),
    small_batch: bool = False,
) -> dict[str, DataFrame]:
    """Rows to append to the named hubs, links and satellites (default: all).

    Without ``existing`` the result is the full vault. A source may be None when none of the
    named tables reads it.
    """
    staged = {}
    if readings is not None:
        staged["readings"] = stage_readings(readings)
    if prices is not None:
        staged["prices"] = stage_prices(prices)
    existing = existing or {}
    return {
        name: MODELS[name].rows(staged[MODELS[name].source], existing.get(name), small_batch)
        for name in tables
    }


def load_pit(
    name: str, vault: Mapping[str, DataFrame], snapshots: DataFrame
) -> DataFrame:
    """One point-in-time table of the retained snapshots, cleaned of the others."""
    owner, key, sat, trigger, dimension = PITS[name]
    rows = pit(
        vault[owner], key, {sat: vault[sat]}, snapshots, trigger, dimension,
        slice_unit=MODELS[sat].slice_unit,
    )
    return clean_pit(rows, snapshots, trigger)


def load_pits(
    spark: SparkSession, vault: Mapping[str, DataFrame], as_of: AsOf
) -> dict[str, DataFrame]:
    """All point-in-time tables at ``as_of``."""
    snapshots = retained_snapshots(snapshot_calendar(spark, as_of), as_of)
    return {name: load_pit(name, vault, snapshots) for name in PITS}
