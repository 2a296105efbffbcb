"""Generated calendars.

The range is an argument. Its defaults are the contract's; a fact joined to a calendar is joined
from the fact's side, so that rows outside the range stay, without calendar attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Without arguments the calendar covers [start, end).
SPINE_START = "2020-01-01"
SPINE_END = "2036-01-01"
SPINE_COLUMNS = {"hour": "date_hour", "day": "date_day", "month": "date_month", "year": "date_year"}


def time_spine(
    spark: SparkSession, grain: str, start: str = SPINE_START, end: str = SPINE_END
) -> DataFrame:
    """One row per hour, day, month or year of [start, end); ``start`` is the start of a period."""
    if grain not in SPINE_COLUMNS:
        raise ValueError(f"grain must be one of {sorted(SPINE_COLUMNS)}")
    kind = "timestamp" if grain == "hour" else "date"
    step = f"interval 1 {grain}"
    return spark.range(1).select(
        F.explode(
            F.expr(f"sequence({kind}'{start}', {kind}'{end}' - {step}, {step})")
        ).alias(SPINE_COLUMNS[grain])
    )
