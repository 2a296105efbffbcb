"""File scans and listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"

# Folder patterns of the partition inventory.
RAW_PARTITION = r"year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2}"
CURATED_PARTITION = r"year=\d{4}/month=\d{2}/day=\d{2}"


def text_schema(fields: Sequence[str]) -> T.StructType:
    """Every field as text plus the slot for lines that are not JSON: no inference pass."""
    names = [*fields, CORRUPT]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_ndjson(
    spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Line-delimited JSON, folders read recursively, with the file each line came from.

    Unknown fields are dropped and absent ones are NULL.
    """
    return (
        spark.read.schema(text_schema(fields))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .json(paths if isinstance(paths, str) else list(paths))
        .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    )


def well_formed(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(frame: DataFrame) -> DataFrame:
    """Lines that are not JSON, with whatever fields could still be read from them."""
    fields = [name for name in frame.columns if name not in (CORRUPT, SOURCE_FILE)]
    return frame.filter(F.col(CORRUPT).isNotNull()).select(
        CORRUPT, SOURCE_FILE, F.to_json(F.struct(*fields)).alias("parsed_fields")
    )


def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """Parquet scan. With ``base_path`` partition folders above single files stay columns, and a
    schema naming them as strings keeps ``month=08`` from turning into 8."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    frame = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return frame.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the given folders that exist. Sparse windows have days without data."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()

    def exists(path: str) -> bool:
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(conf).exists(target)

    return [path for path in paths if exists(path)]


def put_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file, replacing one of that name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove one folder, in whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_files(spark: SparkSession, base: str, suffix: str = "") -> DataFrame:
    """Every file below ``base`` as a row. The ``content`` column is never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select(F.col("path").alias("object_uri"), "length", "modificationTime")
    )
    return files.filter(F.col("object_uri").endswith(suffix)) if suffix else files


def partition_inventory(files: DataFrame, prefix: str, pattern: str) -> DataFrame:
    """Sorted distinct partition folders ``prefix/<pattern>`` found in a file listing."""
    folder = F.regexp_extract("object_uri", f"({prefix.strip('/')}/{pattern})/", 1)
    return (
        files.select(folder.alias("partition"))
        .filter(F.col("partition") != "")
        .distinct()
        .orderBy("partition")
    )


def folder_day(path: Column) -> Column:
    """``yyyy-MM-dd`` of the partition folder a file lies in; NULL when there is none."""
    fields = r"year=(\d{4})/month=(\d{2})/day=(\d{2})"
    found = F.concat_ws("-", *[F.regexp_extract(path, fields, group) for group in (1, 2, 3)])
    return F.nullif(found, F.lit("--"))


def object_key(path: Column, root: str) -> Column:
    """Path below the bucket or root folder."""
    return F.regexp_replace(path, rf"^[a-z0-9]*:?/*{re.escape(root.strip('/'))}/", "")
