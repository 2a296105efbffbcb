"""Point-in-time tables that move on by a snapshot instead of being rebuilt."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.operators.vault import LDTS, pit
from tidewatt.sinks.tables import SnapshotTable, stored
from tidewatt.sources.files import drop_folder

PART = "snapshot_day"


@dataclass(frozen=True)
class PitReport:
    added: tuple[str, ...]
    dropped: tuple[str, ...]
    rows_written: int


@dataclass(frozen=True)
class StoredPit:
    """One satellite's point-in-time table below ``path``, a folder for each snapshot.

    Vault loads append in order of load time, so a stored snapshot changes only by hub keys that
    are new. A new snapshot is the last stored one, moved on by the versions loaded since; a
    snapshot that is no longer retained goes with its folder.
    """

    path: str
    hashkey: str
    satellite: str
    dimension_key: str
    slice_unit: str | None = "month"

    @property
    def table(self) -> SnapshotTable:
        schema = (
            f"{self.dimension_key} string, {self.hashkey} string, sdts timestamp, hk_{self.satellite} string,"
            f" ldts_{self.satellite} timestamp, {PART} string"
        )
        return SnapshotTable(self.path, T.StructType.fromDDL(schema), (PART,))

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark).drop(PART)

    def _at(self, keys: DataFrame, versions: DataFrame, snapshots: DataFrame) -> DataFrame:
        rows = pit(
            keys, self.hashkey, {self.satellite: versions}, snapshots, "is_active", self.dimension_key, self.slice_unit
        )
        return rows.withColumn(PART, F.date_format("sdts", "yyyy-MM-dd")).select(*self.table.schema.names)

    def advance(self, hub_rows: DataFrame, sat: DataFrame, snapshots: DataFrame, trigger: str) -> PitReport:
        """Bring the table to the snapshots that ``trigger`` retains.

        At most one snapshot a day is retained, a few hundred in all; only their times are on the
        driver. Repeating a call changes nothing.
        """
        spark = hub_rows.sparkSession
        times = lambda frame: sorted(row[0] for row in frame.select("sdts").distinct().collect())
        listed = lambda moments: spark.createDataFrame([(m, True) for m in moments], "sdts timestamp, is_active boolean")
        wanted = times(snapshots.where(trigger))
        held = times(self.table.read(spark))
        new, kept = [m for m in wanted if m not in held], [m for m in wanted if m in held]
        keys = hub_rows.where(F.col(self.hashkey).isNotNull()).select(self.hashkey)
        loaded = sat.select(self.hashkey, LDTS)
        parts = []
        earlier = [m for m in held if new and m < new[0]]
        if new and not earlier:
            parts.append(self._at(keys, loaded, listed(new)))
        elif new:
            # One row per key from the last snapshot before, and what has been loaded since.
            last = self.table.read(spark).where((F.col(PART) == f"{earlier[-1]:%Y-%m-%d}") & F.col(f"ldts_{self.satellite}").isNotNull())
            carried = last.select(self.hashkey, F.col(f"ldts_{self.satellite}").alias(LDTS))
            known = self.table.read(spark).where(F.col(PART) == f"{earlier[-1]:%Y-%m-%d}").select(self.hashkey)
            fresh_keys = keys.join(known, self.hashkey, "left_anti")
            moved_on = loaded.where(F.col(LDTS) > F.lit(earlier[-1])).unionByName(carried)
            whole = loaded.join(fresh_keys, self.hashkey, "left_semi").where(F.col(LDTS) <= F.lit(earlier[-1]))
            parts.append(self._at(keys, moved_on.unionByName(whole), listed(new)))
        if kept:
            stored_keys = self.table.read(spark).where(F.col(PART) == f"{kept[-1]:%Y-%m-%d}").select(self.hashkey)
            added = stored(keys.join(stored_keys, self.hashkey, "left_anti"), "new-keys")
            if not added.isEmpty():
                versions = loaded.join(added, self.hashkey, "left_semi")
                old = self.table.read(spark).where(F.col(PART).isin([f"{m:%Y-%m-%d}" for m in kept]))
                parts += [old.join(added, self.hashkey, "left_anti"), self._at(added, versions, listed(kept))]
        written = 0
        if parts:
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            rows = stored(rows, "pit")
            written = rows.count()
            self.table.replace(spark, rows)
        dropped = tuple(f"{m:%Y-%m-%d}" for m in held if m not in wanted)
        for day in dropped:
            drop_folder(spark, f"{self.path}/{PART}={day}")
        return PitReport(tuple(f"{m:%Y-%m-%d}" for m in new), dropped, written)
