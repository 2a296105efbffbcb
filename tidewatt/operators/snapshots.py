"""Reporting snapshot calendar and its logarithmic retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.calendar import instant

# First reporting day, daily cut-off, retention spans.
FIRST_DAY = "2020-01-01"
CUT_OFF = "06:00:00"
DAILY_FOR = "interval 30 day"
WEEKLY_FOR = "interval 6 month"
MONTHLY_FOR = "interval 3 year"


AsOf = datetime | Column


def _column(as_of: AsOf) -> Column:
    return as_of if isinstance(as_of, Column) else instant(as_of)


def snapshot_calendar(
    spark: SparkSession, as_of: AsOf, first_day: str = FIRST_DAY, cut_off: str = CUT_OFF
) -> DataFrame:
    """One snapshot per day up to the day of ``as_of``, at the business cut-off.

    ``as_of`` replaces the wall clock: a datetime, or a column such as a scalar subquery over
    the loaded data.
    """
    first = F.to_timestamp(F.lit(f"{first_day} {cut_off}"))
    last = F.to_timestamp(F.concat_ws(" ", F.to_date(_column(as_of)), F.lit(cut_off)))
    return spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("sdts")
    )


def retained_snapshots(calendar: DataFrame, as_of: AsOf) -> DataFrame:
    """Flag the snapshots kept: days for a month, Mondays for half a year, firsts of the month
    for three years, New Year's days for ever; and the latest one reached."""
    now = _column(as_of)
    today, day = F.to_date(now), F.to_date("sdts")
    reached = F.col("sdts") <= now
    kept = (
        (day >= today - F.expr(DAILY_FOR))
        | ((F.weekday(day) == 0) & (day >= today - F.expr(WEEKLY_FOR)))
        | ((F.dayofmonth(day) == 1) & (day >= today - F.expr(MONTHLY_FOR)))
        | ((F.dayofmonth(day) == 1) & (F.month(day) == 1))
    )
    latest = calendar.filter(reached).agg(F.max("sdts")).scalar()
    return calendar.select(
        "sdts",
        (reached & kept).alias("is_active"),
        F.coalesce(F.col("sdts") == latest, F.lit(False)).alias("is_latest"),
    )
