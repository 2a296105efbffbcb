"""Calendar expressions used by dimensions, facts and marts."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period grain, its sort order.
GRAINS = (("Year", 1), ("Month", 2), ("Week", 3), ("Day", 4), ("Hour", 5))
GRAIN_NAMES = tuple(name for name, _ in GRAINS)


def instant(moment: datetime) -> Column:
    """Timestamp literal: zoned values are converted to UTC, naive ones are session time."""
    if moment.tzinfo is None:
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp")
    return F.lit(moment.astimezone(UTC).isoformat(sep=" ")).cast("timestamp")


def truncate(grain: str, moment: Column) -> Column:
    return F.date_trunc(grain.lower(), moment)


def date_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd").cast("int")


def iso_day_of_week(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + F.lit(1)


def day_part(hour: Column) -> Column:
    return (
        F.when(hour < 6, "Overnight")
        .when(hour < 12, "Morning")
        .when(hour < 18, "Afternoon")
        .otherwise("Evening")
    )


def partition_fields(moment: Column) -> dict[str, Column]:
    """Text partition columns of the curated zone, from the UTC date."""
    return {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }


def partition_fields_from_text(moment_text: Column) -> dict[str, Column]:
    """Partition columns of the raw zone, cut from the timestamp's own characters."""
    return {
        "year": moment_text.substr(1, 4),
        "month": moment_text.substr(6, 2),
        "day": moment_text.substr(9, 2),
        "hour": moment_text.substr(12, 2),
    }
