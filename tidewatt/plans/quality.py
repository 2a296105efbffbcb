"""The data-quality suite of every layer."""

from __future__ import annotations

from tidewatt.contracts import REGIONS
from tidewatt.functions.calendar import GRAIN_NAMES
from tidewatt.operators.checks import (
    Check,
    accepted_range,
    accepted_values,
    ghost_records,
    matched,
    not_empty,
    not_null,
    relationship,
    unique,
)


def _keys(table: str, *columns: str) -> list[Check]:
    return [check for name in columns for check in (not_null(table, name), unique(table, name))]


def _present(table: str, *columns: str) -> list[Check]:
    return [not_null(table, name) for name in columns]


def core_checks() -> list[Check]:
    """Source tables and staging."""
    readings, prices = "smart_meter_events", "electricity_prices"
    return [
        *_keys(readings, "event_id"),
        *_present(
            readings, "meter_id", "us_region", "state_code", "event_time", "energy_kwh",
            "voltage_v", "current_a", "power_factor", "schema_version",
        ),
        not_empty(readings, "meter_id"),
        not_empty(readings, "schema_version"),
        accepted_values(readings, "us_region", REGIONS),
        accepted_range(readings, "energy_kwh", 0),
        accepted_range(readings, "voltage_v", 0, inclusive=False),
        accepted_range(readings, "current_a", 0),
        accepted_range(readings, "power_factor", 0, 1),
        *_keys(prices, "price_id"),
        *_present(prices, "us_region", "state_code", "effective_from", "price_per_kwh"),
        accepted_values(prices, "us_region", REGIONS),
        accepted_range(prices, "price_per_kwh", 0),
        *_present("stg_meter_readings", "hk_meter_h", "hk_reading_h"),
        unique("stg_electricity_prices", "state_code", "effective_from"),
    ]


def vault_checks() -> list[Check]:
    return [
        *_keys("hub_meter", "hk_meter_h", "meter_id"),
        *_keys("hub_reading", "hk_reading_h"),
        *_keys("link_meter_reading", "hk_meter_reading_l"),
        *_keys("hub_pricing_zone", "hk_pricing_zone_h", "state_code"),
        *_keys("hub_price", "hk_price_h", "price_id"),
        *_keys("link_pricing_zone_price", "hk_pricing_zone_price_l"),
        *_keys("link_meter_pricing_zone", "hk_meter_pricing_zone_l"),
        *_present("link_meter_pricing_zone", "hk_meter_h", "hk_pricing_zone_h"),
        relationship("link_meter_pricing_zone", "hk_meter_h", "hub_meter", "hk_meter_h"),
        relationship(
            "link_meter_pricing_zone", "hk_pricing_zone_h", "hub_pricing_zone", "hk_pricing_zone_h"
        ),
        unique("sat_price_details", "hk_price_h", "ldts"),
        unique("sat_pricing_zone_details", "hk_pricing_zone_h", "ldts"),
        ghost_records(
            {
                "hub_meter": "hk_meter_h",
                "hub_reading": "hk_reading_h",
                "link_meter_reading": "hk_meter_reading_l",
                "sat_meter_details": "hk_meter_h",
                "sat_reading_metrics": "hk_reading_h",
            }
        ),
    ]


def business_vault_checks() -> list[Check]:
    checks = [
        *_keys("control_snap_v0", "sdts"),
        *_keys("control_snap_v1", "sdts"),
        *_present("control_snap_v1", "is_active", "is_latest"),
        accepted_values("control_snap_v1", "is_active", [True, False]),
        accepted_values("control_snap_v1", "is_latest", [True, False]),
    ]
    for entity in ("meter", "reading", "price", "pricing_zone"):
        table, key = f"pit_{entity}", f"hk_{entity}_h"
        checks += [
            unique(table, key, "sdts"),
            *_keys(table, f"hk_{entity}_d"),
            *_present(table, key, "sdts"),
        ]
    return checks


def information_checks() -> list[Check]:
    prices, priced = "int_electricity_prices", "int_meter_readings_priced"
    return [
        unique(prices, "state_code", "effective_from"),
        *_keys(prices, "price_id"),
        *_present(prices, "state_code", "effective_from", "price_per_kwh"),
        *_keys(priced, "event_id"),
        *_present(priced, "price_id", "price_per_kwh", "usage_revenue"),
        matched(
            "int_meter_readings", "event_id", priced, ["event_id", "state_code", "event_time"],
            "meter_readings_have_effective_price",
        ),
    ]


def _dimension_links(fact: str) -> list[Check]:
    links = {
        "meter_key": "dim_meter",
        "pricing_zone_key": "dim_pricing_zone",
        "date_key": "dim_date",
        "time_key": "dim_time",
    }
    return [
        check
        for key, dimension in links.items()
        for check in (not_null(fact, key), relationship(fact, key, dimension, key))
    ]


def _mart(table: str, measure: str) -> list[Check]:
    return [
        *_present(table, "period_grain", "period_start", measure),
        accepted_values(table, "period_grain", GRAIN_NAMES),
        unique(table, "period_grain", "period_start", "meter_id", "state_code"),
    ]


def presentation_checks() -> list[Check]:
    return [
        *_keys("dim_meter", "meter_key", "meter_id"),
        *_keys("dim_date", "date_key"),
        *_keys("dim_time", "time_key"),
        *_keys("dim_pricing_zone", "pricing_zone_key", "state_code"),
        unique("fact_hourly_energy_billing", "meter_key", "reading_hour"),
        *_dimension_links("fact_hourly_energy_billing"),
        *_keys("fact_meter_reading", "reading_key", "event_id"),
        *_dimension_links("fact_meter_reading"),
        *_mart("mart_meter_operations_periodic", "reading_count"),
        not_null("mart_meter_operations_periodic", "meter_id"),
        *_mart("mart_executive_billing_periodic", "gross_billed"),
    ]


def spine_checks() -> list[Check]:
    columns = {
        "time_spine_hourly": "date_hour",
        "time_spine_daily": "date_day",
        "time_spine_monthly": "date_month",
        "time_spine_yearly": "date_year",
    }
    return [check for table, column in columns.items() for check in _keys(table, column)]


def warehouse_constraints(table: str, key: str, required: list[str]) -> list[Check]:
    """Constraints of a source-aligned table: NOT NULL and the primary key."""
    return [*_present(table, *required), unique(table, key)]
