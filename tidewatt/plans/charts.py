"""Dashboard queries over the periodic marts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.arithmetic import real_ratio
from tidewatt.functions.calendar import GRAIN_NAMES, instant

# Default grain and top-k of the dashboards.
DEFAULT_GRAIN = "Year"
TOP_METERS = 10

_AGGREGATES: dict[str, Callable[[str], Column]] = {
    "SUM": F.sum,
    "COUNT_DISTINCT": F.count_distinct,
    "MIN": F.min,
    "MAX": F.max,
    "AVG": F.avg,
    "COUNT": F.count,
}


def metric(label: str, aggregate: str, column: str) -> Column:
    return _AGGREGATES[aggregate](column).alias(label)


def sql_metric(label: str, expression: str) -> Column:
    return F.expr(expression).alias(label)


def _ratio(label: str, numerator: str, denominator: str) -> Column:
    return real_ratio(F.sum(numerator), F.sum(denominator)).alias(label)


@dataclass(frozen=True)
class Chart:
    """Metrics over one mart. ``metrics`` is a function, as columns need a live session."""

    mart: str
    metrics: Callable[[], list[Column]]
    group_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    descending: str | None = None
    limit: int | None = None


def _gross() -> Column:
    return metric("gross_billed_usd", "SUM", "gross_billed")


def _net() -> Column:
    return metric("net_revenue_usd", "SUM", "net_revenue")


def _energy(label: str = "energy_kwh") -> Column:
    return metric(label, "SUM", "energy_kwh")


def _voltage() -> Column:
    return _ratio("average_voltage_v", "voltage_sum", "reading_count")


def _factor() -> Column:
    return _ratio("average_power_factor", "power_factor_sum", "reading_count")


def _price() -> Column:
    return _ratio("realized_usd_per_kwh", "net_revenue", "energy_kwh")


_TREND = ("period_start", "us_region")
CHARTS = {
    "Gross Billed": Chart("billing", lambda: [_gross()]),
    "Net Revenue": Chart("billing", lambda: [_net()]),
    "Billed Energy": Chart("billing", lambda: [_energy("billed_energy_kwh")]),
    "Active Billed Meters": Chart(
        "billing", lambda: [metric("billed_meters", "COUNT_DISTINCT", "meter_id")]
    ),
    "Billing Trend": Chart(
        "billing", lambda: [_gross(), _net()], _TREND, _TREND,
    ),
    "Revenue by US Region": Chart("billing", lambda: [_net()], ("us_region",), ("us_region",)),
    "Revenue by State": Chart("billing", lambda: [_net()], ("state_code",), ("state_code",)),
    "Realized Price per kWh": Chart(
        "billing", lambda: [_price()], _TREND, _TREND,
    ),
    "Total Energy Consumed": Chart("operations", lambda: [_energy()]),
    "Total Meter Readings": Chart(
        "operations", lambda: [metric("readings", "SUM", "reading_count")]
    ),
    "Reporting Meters": Chart(
        "operations", lambda: [metric("meters", "COUNT_DISTINCT", "meter_id")]
    ),
    "Energy Consumption Trend": Chart(
        "operations", lambda: [_energy()], ("period_start",), ("period_start",),
    ),
    "Top Meters by Energy": Chart(
        "operations", lambda: [_energy()], ("meter_id",), ("meter_id",), "energy_kwh", TOP_METERS
    ),
    "Electrical Health Trend": Chart(
        "operations",
        lambda: [_voltage(), _factor()],
        ("period_start",),
        ("period_start",),
    ),
    "Average Voltage": Chart("operations", lambda: [_voltage()]),
    "Average Power Factor": Chart("operations", lambda: [_factor()]),
}


def in_scope(
    mart: DataFrame,
    grain: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """One grain, always: a mart holds all five, and mixing them counts everything five times.
    The time range is inclusive on both ends."""
    if grain not in GRAIN_NAMES:
        raise ValueError(f"grain must be one of {', '.join(GRAIN_NAMES)}")
    scoped = mart.filter(F.col("period_grain") == grain)
    if start is not None:
        scoped = scoped.filter(F.col("period_start") >= instant(start))
    if end is not None:
        scoped = scoped.filter(F.col("period_start") <= instant(end))
    return scoped


def totals(
    mart: DataFrame,
    names: tuple[str, ...],
    grain: str = DEFAULT_GRAIN,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Several single-number charts of one mart in one pass."""
    scoped = in_scope(mart, grain, start, end)
    return scoped.agg(*[column for name in names for column in CHARTS[name].metrics()])


def chart(
    name: str,
    mart: DataFrame,
    grain: str = DEFAULT_GRAIN,
    start: datetime | None = None,
    end: datetime | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Run one chart. All rows, but for a top-k chart or where the caller passes ``limit``.

    Charts are ordered with a tie-break, so a limit always keeps the same rows.
    """
    spec = CHARTS[name]
    scoped = in_scope(mart, grain, start, end)
    if not spec.group_by:
        return scoped.agg(*spec.metrics())
    result = scoped.groupBy(*spec.group_by).agg(*spec.metrics())
    order = [F.col(column).asc() for column in spec.order_by]
    if spec.descending is not None:
        order.insert(0, F.col(spec.descending).desc())
    result = result.orderBy(*order)
    rows = spec.limit if limit is None else limit
    return result if rows is None else result.limit(rows)


def grain_order(mart: DataFrame) -> DataFrame:
    """Grains of a mart in drill-down order."""
    return (
        mart.groupBy("period_grain")
        .agg(F.min("period_grain_order").alias("period_grain_order"))
        .orderBy("period_grain_order")
    )
