"""Totals kept current load by load: only what a load touches is computed again.

A load brings new, late and corrected rows. From the batch and from what the table holds under its
ids follow the touched (group, hour) keys. Only their hours are summed again, from the rows of
their days; only the days of those hours, from hours; only the weeks, months and years of those
days, from days. Nothing is added to or taken from a total, so a load that is repeated, in part or
as a whole, ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.functions.calendar import GRAINS, truncate
from tidewatt.operators.keyed import latest_by_key
from tidewatt.operators.rollup import PERIOD
from tidewatt.sinks.tables import SnapshotTable, stored

HOUR, COUNT, VOID, ASKED = "period_hour", "n_rows", "is_void", "__asked"
ROW_DAY, HOUR_DAY, PART = "row_day", "hour_day", "period_part"
GRAIN, _, START = PERIOD
#: Grains summed from days.
LONGER = tuple(name for name, _ in GRAINS if name not in ("Hour", "Day"))


@dataclass(frozen=True)
class LoadReport:
    """What one load touched, and how much it computed again."""

    touched_hours: int
    rows_summed: int
    touched_periods: int


def _day(moment: Column) -> Column:
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit("none"))


def _part(grain: Column, start: Column) -> Column:
    return F.concat_ws("-", grain, F.coalesce(F.year(start).cast("string"), F.lit("none")))


@dataclass(frozen=True)
class IncrementalTotals:
    """Rows, hours and periods in three tables below ``path``.

    ``by`` and ``sums`` map columns to their types; sums are decimals, so the order of adding does
    not matter. ``version`` orders the rows of one id in a batch: the last one counts. A row with
    ``is_void`` true takes its id out of the totals. A row without a moment is in the hour NULL.
    Where a correction never carries another moment, ``fixed_moment`` saves looking for the ids of a
    batch outside its own days.
    """

    path: str
    id_column: str
    moment: str
    by: tuple[tuple[str, str], ...]
    sums: tuple[tuple[str, str], ...]
    version: tuple[str, ...] = ()
    fixed_moment: bool = False

    @property
    def groups(self) -> list[str]:
        return [name for name, _ in self.by]

    def _table(self, name: str, columns: str, *parts: str) -> SnapshotTable:
        own = [f"`{n}` {kind}" for n, kind in self.by]
        schema = ", ".join([columns, *own, *[f"{part} string" for part in parts]])
        return SnapshotTable(f"{self.path}/{name}", T.StructType.fromDDL(schema), parts)

    @property
    def rows(self) -> SnapshotTable:
        values = "".join(f"`{n}` {kind}, " for n, kind in self.sums)
        return self._table("rows", f"`{self.id_column}` string, `{self.moment}` timestamp, {values}{VOID} boolean", ROW_DAY)

    def _totals(self) -> str:
        return "".join(f"`{n}` decimal(38,{kind.rstrip(')').split(',')[1].strip()}), " for n, kind in self.sums) + f"{COUNT} bigint"

    @property
    def hours(self) -> SnapshotTable:
        return self._table("hours", f"{HOUR} timestamp, {self._totals()}", HOUR_DAY)

    @property
    def periods(self) -> SnapshotTable:
        return self._table("periods", f"{GRAIN} string, {START} timestamp, {self._totals()}", PART)

    @property
    def pending(self) -> SnapshotTable:
        """Touched keys of a load under way. They outlive a failed run, so that the next one knows
        keys which the rows no longer show."""
        return self._table("pending", f"{HOUR} timestamp")

    def load(self, batch: DataFrame) -> LoadReport:
        """Bring the tables up to date with ``batch``: one row per id, new, late or corrected."""
        spark = batch.sparkSession
        fresh = stored(self._fresh(batch), "batch")
        touched = self._store_rows(spark, fresh)
        rows_summed = self._store_hours(spark, touched)
        periods = self._store_periods(spark, touched)
        report = LoadReport(touched.count(), rows_summed, periods)
        self.pending.replace(spark, touched.limit(0))
        return report

    def _fresh(self, batch: DataFrame) -> DataFrame:
        void = F.coalesce(F.col(VOID), F.lit(False)) if VOID in batch.columns else F.lit(False)
        rows = batch.select(
            F.col(self.id_column).cast("string").alias(self.id_column),
            *[F.col(n).cast(kind).alias(n) for n, kind in (*self.by, *self.sums)],
            F.col(self.moment).cast("timestamp").alias(self.moment),
            void.alias(VOID),
            *[F.col(n) for n in self.version if n not in (*self.groups, self.moment)],
        )
        last = latest_by_key(rows, [self.id_column], [*self.version, self.moment, *[n for n, _ in self.sums], *self.groups])
        return last.withColumn(ROW_DAY, _day(F.col(self.moment))).select(*self.rows.schema.names)

    def _keys(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.date_trunc("hour", F.col(self.moment)).alias(HOUR), *self.groups)

    def _store_rows(self, spark: SparkSession, fresh: DataFrame) -> DataFrame:
        """Put the batch into the row table; the touched (group, hour) keys, stored beforehand.

        A corrected row that has moved to another day leaves a void row behind: a day folder that
        lost its last row would otherwise not be rewritten.
        """
        table = self.rows.read(spark)
        if self.fixed_moment:
            table = table.where(F.col(ROW_DAY).isin(_listed(fresh, ROW_DAY)))
        ids = fresh.select(self.id_column, F.col(ROW_DAY).alias("__new_day"))
        before = table.where(~F.col(VOID)).join(ids, self.id_column, "left_semi")
        keys = self._keys(before).unionByName(self._keys(fresh)).unionByName(self.pending.read(spark).select(HOUR, *self.groups))
        self.pending.replace(spark, keys.distinct().select(*self.pending.schema.names))
        days = _listed(before.select(ROW_DAY).unionByName(fresh.select(ROW_DAY)), ROW_DAY)
        held = table.where(F.col(ROW_DAY).isin(days)).join(ids, self.id_column, "left")
        stays = held.where(F.col("__new_day").isNull() | (F.col("__new_day") != F.col(ROW_DAY)))
        stays = stays.withColumn(VOID, F.col(VOID) | F.col("__new_day").isNotNull())
        self.rows.replace(spark, stays.select(*fresh.columns).unionByName(fresh))
        return self.pending.read(spark)

    def _totals_of(self, touched: DataFrame, source: DataFrame, keys: Sequence[str], again: bool) -> DataFrame:
        """A total for every touched key; a key that lost all its rows keeps a row of count 0, which
        replaces the old one and which no reader sees.

        The touched keys are grouped together with the rows, so all meet in one shuffle.
        """
        names = [n for n, _ in self.sums] + ([COUNT] if again else [])
        rows = source.select(*keys, *names, F.lit(False).alias(ASKED))
        nothing = [F.lit(None).cast(source.schema[n].dataType).alias(n) for n in names]
        asked = touched.select(*keys, *nothing, F.lit(True).alias(ASKED))
        count = F.coalesce(F.sum(COUNT), F.lit(0)) if again else F.count_if(~F.col(ASKED))
        totals = rows.unionByName(asked).groupBy(*keys).agg(
            *[F.sum(F.col(n)).cast(f).alias(n) for n, f in self._sum_types()], count.cast("bigint").alias(COUNT), F.max(ASKED).alias(ASKED)
        )
        return totals.where(ASKED).drop(ASKED)

    def _sum_types(self) -> list[tuple[str, str]]:
        return [(n, f"decimal(38,{kind.rstrip(')').split(',')[1].strip()})") for n, kind in self.sums]

    def _replace(self, spark: SparkSession, table: SnapshotTable, fresh: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
        """Rewrite the folders of ``fresh``: its keys are replaced, other keys stay."""
        fresh = stored(fresh.select(*table.schema.names), "totals")
        held = table.read(spark).where(F.col(part).isin(_listed(fresh, part)))
        same = reduce(Column.__and__, [held[k].eqNullSafe(fresh[k]) for k in keys])
        table.replace(spark, held.join(fresh, same, "left_anti").unionByName(fresh))
        return fresh

    def _store_hours(self, spark: SparkSession, touched: DataFrame) -> int:
        keys = [HOUR, *self.groups]
        rows = self.rows.read(spark).where(~F.col(VOID))
        days = _listed(touched.select(_day(F.col(HOUR)).alias(ROW_DAY)), ROW_DAY)
        rows = rows.where(F.col(ROW_DAY).isin(days)).withColumn(HOUR, F.date_trunc("hour", F.col(self.moment)))
        fresh = self._totals_of(touched, rows, keys, again=False).withColumn(HOUR_DAY, _day(F.col(HOUR)))
        done = self._replace(spark, self.hours, fresh, keys, HOUR_DAY)
        return done.agg(F.coalesce(F.sum(COUNT), F.lit(0))).first()[0]

    def _store_periods(self, spark: SparkSession, touched: DataFrame) -> int:
        """Days from the hours of the touched days, then longer periods from the days in them."""
        keys = [GRAIN, START, *self.groups]
        day = F.date_trunc("day", F.col(HOUR))
        touched_days = stored(touched.select(F.lit("Day").alias(GRAIN), day.alias(START), *self.groups).distinct(), "days")
        hours = self.hours.read(spark).where(F.col(HOUR_DAY).isin(_listed(touched_days.select(_day(F.col(START)).alias(HOUR_DAY)), HOUR_DAY)))
        hours = hours.where(f"{COUNT} > 0").select(F.lit("Day").alias(GRAIN), day.alias(START), *self.groups, *[n for n, _ in self.sums], COUNT)
        changed = self._stored_periods(spark, touched_days, hours, keys)

        spans = F.array(*[F.struct(F.lit(name).alias(GRAIN), truncate(name, F.col(START)).alias(START)) for name in LONGER])
        longer = touched_days.select(F.explode(spans).alias("span"), *self.groups).select("span.*", *self.groups).distinct()
        longer = stored(longer, "longer")
        # Days of the touched periods: a week may reach into the next year.
        ends = longer.select(_part(F.lit("Day"), F.col(START)).alias(PART)).unionByName(
            longer.where(f"{GRAIN} = 'Week'").select(_part(F.lit("Day"), F.col(START) + F.expr("interval 6 day")).alias(PART))
        )
        days = self.periods.read(spark).where(F.col(PART).isin(_listed(ends, PART))).where(f"{COUNT} > 0")
        spread = days.select(F.explode(spans).alias("span"), *self.groups, *[n for n, _ in self.sums], COUNT).select(
            "span.*", *self.groups, *[n for n, _ in self.sums], COUNT
        )
        return changed + self._stored_periods(spark, longer, spread, keys)

    def _stored_periods(self, spark: SparkSession, touched: DataFrame, source: DataFrame, keys: list[str]) -> int:
        fresh = self._totals_of(touched, source, keys, again=True).withColumn(PART, _part(F.col(GRAIN), F.col(START)))
        return self._replace(spark, self.periods, fresh, keys, PART).count()

    def read_hours(self, spark: SparkSession) -> DataFrame:
        return self.hours.read(spark).where(f"{COUNT} > 0").drop(HOUR_DAY)

    def read(self, spark: SparkSession) -> DataFrame:
        """All grains in the layout of ``periodic_totals``: no period starts before the first hour."""
        hours = self.read_hours(spark)
        first = hours.agg(F.min(HOUR)).scalar()
        periods = self.periods.read(spark).where(f"{COUNT} > 0").drop(PART)
        all_grains = periods.unionByName(hours.withColumnRenamed(HOUR, START).withColumn(GRAIN, F.lit("Hour")))
        order = F.create_map(*[F.lit(x) for pair in GRAINS for x in pair])
        return all_grains.select(
            GRAIN,
            order[F.col(GRAIN)].cast("smallint").alias(PERIOD[1]),
            F.when(F.col(START).isNotNull(), F.greatest(F.col(START), first)).alias(START),
            *self.groups,
            *[n for n, _ in self.sums],
            COUNT,
        )


def _listed(frame: DataFrame, column: str) -> list[str]:
    """Folder names that a load touches: calendar days or years, a few thousand at the most."""
    return [row[0] for row in frame.select(column).distinct().collect()]
