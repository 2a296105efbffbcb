"""Continuous ingest and the streaming forms of de-duplication, pricing and hourly billing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.functions.calendar import partition_fields_from_text
from tidewatt.operators.asof import asof_join
from tidewatt.operators.keyed import first_by_key
from tidewatt.session import work_folder
from tidewatt.sources.files import (
    CORRUPT,
    SOURCE_FILE,
    malformed,
    text_schema,
    well_formed,
)


@dataclass(frozen=True)
class Buffering:
    """Delivery buffer: flush after a time, or once a batch would exceed a size."""

    interval_seconds: int
    size_mb: int

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.interval_seconds} seconds"}

    def read_options(self) -> dict[str, str]:
        return {"maxBytesPerTrigger": str(self.size_mb * 1024 * 1024)}


# Buffers of the local and the other environments.
LOCAL_BUFFER = Buffering(interval_seconds=5, size_mb=1)
DEFAULT_BUFFER = Buffering(interval_seconds=60, size_mb=64)
ONCE = {"availableNow": True}


def ndjson_stream(
    spark: SparkSession,
    path: str,
    fields: Sequence[str],
    buffering: Buffering | None = None,
) -> DataFrame:
    """NDJSON folder as a stream of text fields. A connector's DataFrame can take its place."""
    reader = (
        spark.readStream.schema(text_schema(fields))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
    )
    for name, value in (buffering.read_options() if buffering else {}).items():
        reader = reader.option(name, value)
    return reader.json(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_glob: str = "*.parquet"
) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(path)


def landing(stream: DataFrame, time_field: str) -> DataFrame:
    """Records with the folder columns cut from the characters of their time field."""
    return stream.withColumns(partition_fields_from_text(F.col(time_field)))


def start_landing(
    stream: DataFrame,
    time_field: str,
    destination: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
    data_format: str = "json",
):
    """Append well-formed records to event-time folders. There is no watermark: a late record
    lands in the folder of its own time. Keep this folder apart from batch-written ones, as a
    stream sink's own log hides files it did not write."""
    good = well_formed(stream) if CORRUPT in stream.columns else stream
    return (
        landing(good, time_field)
        .writeStream.format(data_format)
        .partitionBy("year", "month", "day", "hour")
        .option("path", destination)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_error_landing(
    stream: DataFrame,
    destination: str,
    checkpoint: str,
    processed_at: Column | None = None,
    trigger: Mapping[str, object] = ONCE,
):
    """Append records that are not JSON below their error type and processing hour."""
    moment = F.current_timestamp() if processed_at is None else processed_at
    bad = malformed(stream).select(
        F.col(CORRUPT).alias("record"),
        F.col(SOURCE_FILE).alias("record_source"),
        "parsed_fields",
        F.lit("processing-failed").alias("error_type"),
        *[
            F.date_format(moment, pattern).alias(name)
            for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))
        ],
    )
    return (
        bad.writeStream.format("json")
        .partitionBy("error_type", "year", "month", "day", "hour")
        .option("path", destination)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def deduplicated(
    stream: DataFrame, keys: Sequence[str], time_column: str, delay: str = "1 day"
) -> DataFrame:
    """First arrival per key; duplicates up to ``delay`` apart are dropped, and so is a row later
    than that. ``unique_rows`` has neither bound."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def priced(
    stream: DataFrame,
    tariffs: DataFrame,
    strategy: str = "bucket",
) -> DataFrame:
    """Readings joined to the current price intervals, which are static for the batch.

    The condition is the batch one, for any event time. The carried timeline needs a window over
    the stream, so only the two bucket joins apply.
    """
    return asof_join(
        stream, tariffs, by=["state_code"], also=["us_region"], left_ts="event_time",
        valid_from="price_effective_from", valid_to="effective_to",
        strategy=strategy,
    )


def hourly_totals(
    stream: DataFrame,
    time_column: str,
    by: Sequence[str],
    sums: Mapping[str, str],
    delay: str = "1 hour",
    count: str = "reading_count",
) -> DataFrame:
    """Tumbling one-hour totals, emitted once the watermark has passed the window. Rows later than
    ``delay`` and open windows are left out; ``hour_table`` over the landed rows has both."""
    window = F.window(time_column, "1 hour")
    return (
        stream.withWatermark(time_column, delay)
        .groupBy(window, *by)
        .agg(
            *[F.sum(column).alias(name) for name, column in sums.items()],
            F.count(F.lit(1)).alias(count),
        )
        .select(F.col("window.start").alias("reading_hour"), *by, *sums, count)
    )


def run_available(stream: DataFrame, purpose: str = "stream", folder: str | None = None) -> DataFrame:
    """Process what is there, into Parquet in the shared work folder, and read the result back."""
    spark = stream.sparkSession
    base = folder or work_folder(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def hour_table(
    landed: DataFrame,
    time_column: str,
    by: Sequence[str],
    sums: Mapping[str, str],
    count: str = "reading_count",
) -> DataFrame:
    """One-hour totals of all rows that ``run_available`` has landed.

    The landing has no watermark, so a late row counts in its own hour and the last hours are
    there, as far as they have come. A row without time is in the hour NULL.
    """
    return landed.groupBy(F.date_trunc("hour", time_column).alias("reading_hour"), *by).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()],
        F.count(F.lit(1)).alias(count),
    )


def closed_hours(
    hours: DataFrame, landed: DataFrame, time_column: str, delay: str = "1 hour"
) -> DataFrame:
    """The hours that end ``delay`` or more before the last event time."""
    last = landed.agg(F.max(time_column)).scalar()
    return hours.filter(
        F.col("reading_hour") + F.expr("interval 1 hour") <= last - F.expr(f"interval {delay}")
    )


def unique_rows(landed: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """The earliest row per key of all that ``run_available`` has landed, however far apart."""
    return first_by_key(landed, keys, [F.col(time_column).asc_nulls_last()])
