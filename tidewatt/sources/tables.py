"""Source-aligned tables as the vault reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatt.contracts import PRICE_FIELDS, READING_FIELDS

AUDIT_COLUMNS = ("bucket_name", "object_key", "source_line_number", "record_source")
LOADED = "load_datetime"


def table_source(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view, or a Parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def source_meter_readings(table: DataFrame) -> DataFrame:
    """The columns the readings model uses, and no others."""
    return table.select(*[name for name, _, _ in READING_FIELDS], *AUDIT_COLUMNS, LOADED)


def source_electricity_prices(table: DataFrame) -> DataFrame:
    return table.select(*[name for name, _, _ in PRICE_FIELDS], LOADED)
