"""Streams that keep tables current without reading what has landed again."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.operators.asof import asof_join
from tidewatt.plans.incremental import VOID, IncrementalTotals, LoadReport
from tidewatt.sinks.tables import SnapshotTable, stored

HOUR, EPOCH, DAY, COUNT = "reading_hour", "last_epoch", "hour_day", "reading_count"
OWN = "__own"


def run_batches(
    stream: DataFrame,
    merge: Callable[[DataFrame, int], object],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> None:
    """Give every micro-batch and its number to ``merge``, until what is there has been read."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, epoch: merge(batch, epoch) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class HourlyMerge:
    """Hourly totals of a stream of rows without ids, merged batch by batch.

    Each hour carries the number of the last batch that was added to it. Spark repeats a batch
    whose end it has not recorded; hours that already carry its number stay as they are, so a
    repeated batch changes nothing. There is no state to expire: a row may be late by years and
    counts in its own hour. A merge rewrites the days of its batch through the table's staging
    folder, so no reader sees half of one. Rows without a time are in the hour NULL.
    """

    path: str
    time_column: str
    by: tuple[tuple[str, str], ...]
    sums: tuple[tuple[str, str], ...]

    @property
    def table(self) -> SnapshotTable:
        columns = [f"`{n}` {kind}" for n, kind in (*self.by, *self.sums)]
        schema = ", ".join([f"{HOUR} timestamp", *columns, f"{COUNT} bigint", f"{EPOCH} bigint", f"{DAY} string"])
        return SnapshotTable(self.path, T.StructType.fromDDL(schema), (DAY,))

    def merge(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        keys = [HOUR, *[n for n, _ in self.by], DAY]
        values = [n for n, _ in self.sums] + [COUNT]
        hour = F.date_trunc("hour", F.col(self.time_column))
        part = stored(
            batch.withColumn(HOUR, hour)
            .withColumn(DAY, F.coalesce(F.date_format(HOUR, "yyyy-MM-dd"), F.lit("none")))
            .groupBy(*keys)
            .agg(*[F.sum(n).cast(kind).alias(n) for n, kind in self.sums], F.count(F.lit(1)).alias(COUNT)),
            "batch-hours",
        )
        # Days of one batch: a short list of folder names.
        days = [row[0] for row in part.select(DAY).distinct().collect()]
        held = self.table.read(spark).where(F.col(DAY).isin(days)).alias("held")
        same = reduce(Column.__and__, [F.col(f"held.{k}").eqNullSafe(F.col(f"part.{k}")) for k in keys])
        both = held.join(part.alias("part"), same, "full_outer")
        add = F.col(f"part.{COUNT}").isNotNull() & (F.col(f"held.{EPOCH}").isNull() | (F.col(f"held.{EPOCH}") < epoch))

        def total(name: str) -> Column:
            old, new = F.col(f"held.{name}"), F.col(f"part.{name}")
            grown = F.coalesce(old + new, old, new)
            return F.when(add, grown).otherwise(old).cast(self.table.schema[name].dataType).alias(name)

        merged = both.select(
            *[F.coalesce(f"held.{k}", f"part.{k}").alias(k) for k in keys],
            *[total(n) for n in values],
            F.when(add, F.lit(epoch).cast("bigint")).otherwise(F.col(f"held.{EPOCH}")).alias(EPOCH),
        )
        self.table.replace(spark, merged.select(*self.table.schema.names))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark).drop(EPOCH, DAY)


@dataclass(frozen=True)
class LivePricing:
    """Priced hourly totals of a stream of readings while tariffs keep arriving.

    ``tariffs`` reads the price intervals as they are now; it is asked once per batch. Intervals
    that differ from those used before give spans of time per key; exactly the readings in those
    spans are priced again, beside the batch's own. Readings are kept by id, so repeated rows and
    batches change nothing, and whatever order readings and tariffs arrive in, the totals are those
    of pricing everything at the end.
    """

    path: str
    totals: IncrementalTotals
    reading_columns: tuple[tuple[str, str], ...]
    tariffs: Callable[[SparkSession], DataFrame]
    price: Callable[[DataFrame], DataFrame]
    by: tuple[str, ...] = ("state_code",)
    also: tuple[str, ...] = ("us_region",)
    valid_from: str = "price_effective_from"
    valid_to: str = "effective_to"

    @property
    def readings(self) -> SnapshotTable:
        columns = ", ".join(f"`{n}` {kind}" for n, kind in self.reading_columns)
        return SnapshotTable(f"{self.path}/readings", T.StructType.fromDDL(f"{columns}, reading_day string"), ("reading_day",))

    def _used(self, schema: T.StructType) -> SnapshotTable:
        return SnapshotTable(f"{self.path}/tariffs", schema)

    def _covered(self, rows: DataFrame, intervals: DataFrame, how: str = "inner") -> DataFrame:
        return asof_join(
            rows, intervals, by=list(self.by), also=list(self.also), left_ts=self.totals.moment,
            valid_from=self.valid_from, valid_to=self.valid_to, how=how, strategy="dyadic",
        )

    def changed_spans(self, before: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(by, also, from, to) in which the interval in force is another one than before: those of
        new or longer intervals, and those of dropped or shorter ones. Each set is disjoint per key.
        """
        start, end = self.valid_from, self.valid_to
        fixed = [name for name in now.columns if name != end]
        b, n = before.withColumn("__there", F.lit(True)).alias("b"), now.withColumn("__there", F.lit(True)).alias("n")
        same = reduce(Column.__and__, [F.col(f"b.{c}").eqNullSafe(F.col(f"n.{c}")) for c in fixed])
        both = b.join(n, same, "full_outer")
        had, has = F.col("b.__there").isNotNull(), F.col("n.__there").isNotNull()
        old_end, new_end = F.col(f"b.{end}"), F.col(f"n.{end}")
        longer = old_end.isNotNull() & (new_end.isNull() | (new_end > old_end))
        shorter = new_end.isNotNull() & (old_end.isNull() | (old_end > new_end))
        keys = [F.coalesce(f"n.{k}", f"b.{k}").alias(k) for k in (*self.by, *self.also)]
        come = both.where(has & (~had | longer)).select(*keys, F.when(had, old_end).otherwise(F.col(f"n.{start}")).alias(start), new_end.alias(end))
        gone = both.where(had & (~has | shorter)).select(*keys, F.when(has, new_end).otherwise(F.col(f"b.{start}")).alias(start), old_end.alias(end))
        return stored(come, "come"), stored(gone, "gone")

    def _days(self, arrived: DataFrame, spans: DataFrame) -> list[str]:
        """Folders of the batch and of the changed spans; open spans end with the last folder."""
        held = self.readings.read(arrived.sparkSession).where("reading_day <> 'none'")
        last = held.agg(F.max("reading_day")).first()[0]
        own = arrived.select("reading_day")
        if last is not None:
            first, end = F.to_date(self.valid_from), F.coalesce(F.to_date(self.valid_to), F.lit(last).cast("date"))
            days = spans.where(first <= end).select(F.explode(F.sequence(first, end)).alias("day"))
            own = own.unionByName(days.select(F.col("day").cast("string").alias("reading_day")))
        return [row[0] for row in own.distinct().collect()]

    def process(self, batch: DataFrame, epoch: int = 0) -> LoadReport:
        """Take in a batch of readings, which may be empty, and the tariffs as they are now."""
        spark = batch.sparkSession
        moment, ids = self.totals.moment, self.totals.id_column
        now = stored(self.tariffs(spark), "tariffs")
        used = self._used(now.schema)
        come, gone = self.changed_spans(used.read(spark), now)
        day = F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit("none")).alias("reading_day")
        arrived = stored(batch.select(*[F.col(n).cast(kind).alias(n) for n, kind in self.reading_columns], day), "arrived")
        own_days = [row[0] for row in arrived.select("reading_day").distinct().collect()]
        self.readings.insert_new(arrived, [ids], [moment], within=F.col("reading_day").isin(own_days))

        days = self._days(arrived, come.unionByName(gone))
        held = self.readings.read(spark).where(F.col("reading_day").isin(days)).drop("reading_day")
        # Read several times by each join to the intervals: computed once.
        own = arrived.select(ids).distinct().withColumn(OWN, F.lit(True))
        held = stored(held.where(F.col(ids).isNotNull()).join(own, ids, "left"), "held")
        others = held.where(F.col(OWN).isNull()).drop(OWN)
        hits = [self._covered(others, spans.withColumn("__hit", F.lit(True))).select(*others.columns) for spans in (come, gone)]
        again = reduce(DataFrame.unionByName, hits).dropDuplicates([ids])
        affected = stored(held.where(OWN).drop(OWN).unionByName(again), "affected")
        priced = self.price(self._covered(affected, now, "left"))
        report = self.totals.load(priced.withColumn(VOID, F.col(self.valid_from).isNull()))
        used.replace(spark, now)
        return report
