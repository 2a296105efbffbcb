"""Ledger of files already processed, by stage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.calendar import instant
from tidewatt.sources.files import existing_paths, list_files

SCHEMA = "stage string, object_uri string, completed_at timestamp, job_run_id string"


@dataclass(frozen=True)
class FileLedger:
    """Rows (stage, object_uri, completed_at, job_run_id) in a Parquet folder."""

    path: str
    stage: str

    @classmethod
    def from_options(cls, table: str | None, stage: str | None) -> FileLedger | None:
        if table is None and stage is None:
            return None
        if not table or not stage:
            raise ValueError("the ledger table and its stage must be supplied together")
        return cls(table, stage)

    def processed(self, spark: SparkSession) -> DataFrame:
        if not existing_paths(spark, [self.path]):
            return spark.createDataFrame([], SCHEMA)
        rows = spark.read.schema(SCHEMA).parquet(self.path)
        return rows.filter(F.col("stage") == self.stage)

    def unseen(self, spark: SparkSession, base: str, data_format: str) -> DataFrame:
        """Files below ``base`` that no committed run of this stage has read, sorted."""
        suffix = ".parquet" if data_format == "parquet" else ""
        return unseen_files(list_files(spark, base, suffix), self.processed(spark))

    def commit(
        self, files: DataFrame, completed_at: datetime, run_id: str
    ) -> None:
        """Record files as done. Call it after every output of the run has succeeded."""
        (
            files.select(
                F.lit(self.stage).alias("stage"),
                "object_uri",
                instant(completed_at).alias("completed_at"),
                F.lit(run_id).alias("job_run_id"),
            )
            .write.mode("append")
            .parquet(self.path)
        )


def unseen_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    return (
        listing.select("object_uri")
        .join(processed.select("object_uri"), "object_uri", "left_anti")
        .orderBy("object_uri")
    )
