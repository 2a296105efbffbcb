"""Snapshot tables with merges, catalog materialisations and constraints on write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.operators.checks import Check, run_checks
from tidewatt.operators.merge import ACTION, INSERTED, KEPT, UPDATED, rows_to_insert, upsert
from tidewatt.session import work_folder
from tidewatt.sources.files import drop_folder, existing_paths, put_marker


@dataclass(frozen=True)
class MergeStats:
    inserted: int
    updated: int = 0
    kept: int = 0


class ConstraintViolation(ValueError):
    pass


class UnfinishedMerge(RuntimeError):
    """A merge whose staging folder is not known to be complete; the table is as it was."""


def enforce(checks: Sequence[Check], tables: dict[str, DataFrame]) -> None:
    """Raise when any check has violations. At most one row per check reaches the driver."""
    broken = run_checks(checks, tables).filter("violations > 0").collect()
    if broken:
        detail = ", ".join(f"{row.table_name}.{row.check_name}={row.violations}" for row in broken)
        raise ConstraintViolation(detail)


@dataclass(frozen=True)
class SnapshotTable:
    """A Parquet folder with a fixed schema. Use ``merge`` of a v2 table format where one is
    configured; plain Parquet has none.

    ``partition_by`` are columns of the table. An upsert rewrites only the partitions its
    source touches, so the upsert keys must determine them.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    checks: tuple[Check, ...] = field(default=())

    @property
    def staging(self) -> str:
        """Next to the table, under a fixed name, so that the next run finds what a run left."""
        return f"{self.path.rstrip('/')}__merge"

    @property
    def marker(self) -> str:
        """Put into the staging folder once it is complete, whatever the cluster's own success
        files are set to; the next staging write removes it with the folder."""
        return f"{self.staging}/_merge_complete"

    def recover(self, spark: SparkSession) -> bool:
        """Finish a merge that stopped after its staging folder was complete; whether there was one.

        Replacing the touched partitions, or the plain table, from a complete staging folder can be
        repeated any number of times. A staging folder without the marker is a write that stopped
        early: the table has not changed and the next merge replaces the folder.
        """
        if not existing_paths(spark, [self.marker]):
            return False
        rows = spark.read.schema(self.schema).parquet(self.staging).select(*self.schema.names)
        self._write(rows, self.path, "overwrite", dynamic=bool(self.partition_by))
        drop_folder(spark, self.staging)
        return True

    def replace(self, spark: SparkSession, rows: DataFrame) -> None:
        """Replace the touched partitions, or the plain table, by ``rows``, which may be built from
        the table itself: they are complete in the staging folder before the table changes."""
        self._write(rows, self.staging, "overwrite")
        self.publish(spark)

    def publish(self, spark: SparkSession) -> None:
        """Mark the staging folder as complete and move it into the table, or raise."""
        put_marker(spark, self.marker)
        if not self.recover(spark):
            raise UnfinishedMerge(f"{self.marker} is missing after the staging write; {self.path} has not changed")

    def read(self, spark: SparkSession) -> DataFrame:
        self.recover(spark)
        if not existing_paths(spark, [self.path]):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def _write(self, frame: DataFrame, path: str, mode: str, dynamic: bool = False) -> None:
        writer = frame.write.mode(mode)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)

    def insert_new(
        self,
        source: DataFrame,
        keys: Sequence[str],
        keep_first_by: Sequence[str] = (),
        small_batch: bool = False,
        within: Column | None = None,
    ) -> MergeStats:
        """Append rows whose key is absent. A repeated run appends nothing.

        ``within`` names the part of the table that can hold the source's keys, if not all of it.
        """
        spark = source.sparkSession
        held = self.read(spark) if within is None else self.read(spark).where(within)
        rows = rows_to_insert(held, source, keys, keep_first_by, small_batch)
        if self.checks:
            # Read by the checks and by the append: computed once.
            rows = stored(rows, "new-rows")
            enforce(self.checks, {"new_rows": rows})
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias(INSERTED))
        self._write(counted, self.path, "append")
        return MergeStats(inserted=seen.get.get(INSERTED, 0))

    def upsert(
        self,
        source: DataFrame,
        keys: Sequence[str],
        update_columns: Sequence[str],
        keep_last_by: Sequence[str] = (),
    ) -> MergeStats:
        """Merge into a staging folder, then replace the touched partitions from it.

        The staging folder is complete before the target changes and goes only after that, so
        whoever reads or writes the table next finishes what a failed run left (``recover``).
        """
        spark = source.sparkSession
        target = self.read(spark)
        if self.partition_by:
            touched = source.select(*self.partition_by).distinct()
            target = target.join(touched, list(self.partition_by), "left_semi")
            target = target.select(*self.schema.names)
        merged = upsert(target, source, keys, update_columns, keep_last_by)
        seen = Observation()
        counted = merged.observe(
            seen,
            *[
                F.count_if(F.col(ACTION) == action).alias(action)
                for action in (INSERTED, UPDATED, KEPT)
            ],
        ).drop(ACTION)
        self._write(counted, self.staging, "overwrite")
        counts = seen.get
        if self.checks:
            rows = spark.read.schema(self.schema).parquet(self.staging).select(*self.schema.names)
            try:
                enforce(self.checks, {"new_rows": rows})
            except ConstraintViolation:
                drop_folder(spark, self.staging)
                raise
        self.publish(spark)
        return MergeStats(
            inserted=counts.get(INSERTED, 0),
            updated=counts.get(UPDATED, 0),
            kept=counts.get(KEPT, 0),
        )


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame that several consumers read to the shared work folder and read it back.

    Cuts the lineage, and survives the loss of executors, unlike a cache.
    """
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def materialize(
    frame: DataFrame,
    name: str,
    kind: str = "view",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Publish a model: ``view`` (recomputed), ``table`` (replaced) or ``incremental`` (appended).

    Bucketing vault tables by their hash key keeps later joins on that key free of shuffles.
    """
    if kind == "view":
        frame.createOrReplaceTempView(name)
        return
    if kind not in ("table", "incremental"):
        raise ValueError("kind must be view, table or incremental")
    writer = frame.write.mode("overwrite" if kind == "table" else "append").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
