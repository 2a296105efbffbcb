"""Partitioned Parquet output and the JSON quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.operators.windows import ProcessingMode


def write_partitioned(
    frame: DataFrame,
    destination: str,
    mode: ProcessingMode,
    partition_columns: Sequence[str],
    rebalance: bool = False,
) -> None:
    """Append new rows, or replace only the partitions a backfill touches.

    The overwrite mode is an option of this write, not of the session. An empty backfill
    replaces nothing. ``rebalance`` gathers wide windows by partition into well-sized files;
    adaptive execution splits a partition that is too big for one task.
    """
    if rebalance:
        frame = frame.hint("rebalance", *[F.col(name) for name in partition_columns])
    writer = frame.write.option("compression", "snappy").partitionBy(*partition_columns)
    if mode is ProcessingMode.BACKFILL:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(destination)


def quarantined(frame: DataFrame) -> DataFrame:
    """Rejected rows with the folder columns of the quarantine, from ``error_timestamp``."""
    moment = F.col("error_timestamp")
    return frame.withColumns(
        {
            "year": F.date_format(moment, "yyyy"),
            "month": F.date_format(moment, "MM"),
            "day": F.date_format(moment, "dd"),
            "hour": F.date_format(moment, "HH"),
        }
    )


QUARANTINE_FOLDERS = ("error_type", "year", "month", "day", "hour")


def write_quarantine(rejected: DataFrame, errors: str) -> None:
    """Append rejected rows as JSON below ``error_type=/year=/month=/day=/hour=``."""
    quarantined(rejected).write.mode("append").partitionBy(*QUARANTINE_FOLDERS).json(errors)


def write_rejected(rejected: DataFrame, errors: str) -> bool:
    """Write only when there is something to write."""
    if rejected.isEmpty():
        return False
    write_quarantine(rejected, errors)
    return True
