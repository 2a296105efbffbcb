"""Which keys were active in which hour, stored as bitmaps and kept load by load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.functions.calendar import instant, truncate
from tidewatt.operators.distinct import BITMAP, BUCKET, NUMBER, bitmaps, dense_numbers, distinct_counts, merged_bitmaps
from tidewatt.sinks.tables import SnapshotTable, stored

HOUR, DAY = "activity_hour", "activity_day"


@dataclass(frozen=True)
class ActivityStore:
    """Bitmaps of the ``key`` values per hour of ``moment`` and ``by``, in folders below ``path``.

    ``by`` maps a dimension to its type. A row without a key is no activity; one without a moment
    is in the hour NULL. Loading the same rows again changes nothing, so a load that stopped is
    simply repeated.
    """

    path: str
    key: str
    moment: str
    by: tuple[tuple[str, str], ...] = ()

    @property
    def dimensions(self) -> list[str]:
        return [name for name, _ in self.by]

    @property
    def numbers(self) -> SnapshotTable:
        return SnapshotTable(f"{self.path}/numbers", T.StructType.fromDDL(f"`{self.key}` string, {NUMBER} bigint"))

    @property
    def hours(self) -> SnapshotTable:
        dims = "".join(f"`{name}` {kind}, " for name, kind in self.by)
        schema = f"{HOUR} timestamp, {dims}{BUCKET} bigint, {BITMAP} binary, {DAY} string"
        return SnapshotTable(f"{self.path}/hours", T.StructType.fromDDL(schema), (DAY,))

    def load(self, rows: DataFrame) -> None:
        """Add the activity of ``rows``. Only the days that the rows touch are rewritten."""
        spark = rows.sparkSession
        hour = F.date_trunc("hour", F.col(self.moment))
        # A busy key is one row per hour and group from here on.
        active = stored(
            rows.where(F.col(self.key).isNotNull())
            .select(F.col(self.key).cast("string").alias(self.key), hour.alias(HOUR), *self.dimensions)
            .distinct(),
            "activity",
        )
        fresh = stored(dense_numbers(active, self.key, self.numbers.read(spark)), "numbers")
        self.numbers.insert_new(fresh, [self.key])
        day = F.coalesce(F.date_format(HOUR, "yyyy-MM-dd"), F.lit("none"))
        batch = bitmaps(
            active.join(self.numbers.read(spark), self.key).withColumn(DAY, day), [HOUR, *self.dimensions, DAY]
        )
        touched = active.select(day.alias(DAY)).distinct()
        kept = self.hours.read(spark).join(touched, DAY, "left_semi").select(*batch.columns)
        merged = merged_bitmaps(kept.unionByName(batch), [HOUR, *self.dimensions, DAY])
        self.hours.replace(spark, merged.select(*self.hours.schema.names))

    def read(self, spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Stored hours of [start, end); whole days outside are not read."""
        rows = self.hours.read(spark)
        for bound, inside in ((start, "__ge__"), (end, "__lt__")):
            if bound is not None:
                edge = instant(bound)
                rows = rows.where(getattr(F.col(HOUR), inside)(edge))
                day = F.date_format(edge, "yyyy-MM-dd")
                rows = rows.where(F.col(DAY) >= day if inside == "__ge__" else F.col(DAY) <= day)
        return rows

    def distinct(
        self,
        spark: SparkSession,
        grain: str | None = None,
        by: Sequence[str] = (),
        name: str = "n_distinct",
        start: datetime | None = None,
        end: datetime | None = None,
    ) -> DataFrame:
        """Distinct keys per period of ``grain`` (none: over all time) and dimensions ``by``.

        Equal to ``count_distinct`` over the rows for every grain and every set of dimensions,
        without touching a row.
        """
        rows = self.read(spark, start, end)
        if grain is None:
            return distinct_counts(rows, list(by), name)
        return distinct_counts(rows.withColumn("period_start", truncate(grain, F.col(HOUR))), ["period_start", *by], name)
