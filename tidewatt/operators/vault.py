"""Data vault loads: stage, hub, link, satellite and point-in-time tables.

Every load is a function of the staged rows and the rows already in the target; it returns the
rows to append. Ghost records do not exist here: each row stems from a source row.

``small_batch`` is for staged rows of one load against a large target: the target is reduced to
the keys of the batch before it is compared. ``repeated`` is for keys that occur in many staged
rows: equal rows collapse in a hash aggregate first, which is cheaper than sorting them all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.hashing import hash_diff, hash_key
from tidewatt.operators.keyed import absent, first_by_key, latest_by_key
from tidewatt.operators.timeline import VALUE, with_next_start, with_previous

LDTS, RSRC = "ldts", "rsrc"


@dataclass(frozen=True)
class HashDiff:
    columns: tuple[str, ...]


def stage(
    source: DataFrame,
    ldts: str,
    rsrc: str,
    hashed_columns: Mapping[str, Sequence[str] | HashDiff],
) -> DataFrame:
    """Source columns plus load time, record source and the declared hashes. No shuffle."""
    hashes = {
        name: hash_diff(spec.columns) if isinstance(spec, HashDiff) else hash_key(spec)
        for name, spec in hashed_columns.items()
    }
    return source.withColumns({LDTS: F.col(ldts), RSRC: F.col(rsrc), **hashes})


def _earliest(
    staged: DataFrame, hash_column: str, columns: Sequence[str], repeated: bool
) -> DataFrame:
    rows = staged.select(hash_column, *columns, LDTS, RSRC)
    if repeated:
        grouped = rows.groupBy(hash_column, *columns, RSRC).agg(F.min(LDTS).alias(LDTS))
        rows = grouped.select(*rows.columns)
    order = [F.col(name).asc_nulls_last() for name in (LDTS, RSRC, *columns)]
    return first_by_key(rows, [hash_column], order, final_tie=False)


def hub(
    staged: DataFrame,
    hashkey: str,
    business_keys: Sequence[str],
    existing: DataFrame | None = None,
    small_batch: bool = False,
    repeated: bool = False,
) -> DataFrame:
    """Earliest row per hash key that the hub lacks; NULL keys are dropped."""
    known = staged.filter(F.col(hashkey).isNotNull())
    rows = _earliest(known, hashkey, business_keys, repeated)
    return rows if existing is None else absent(rows, existing, [hashkey], small_batch)


def link(
    staged: DataFrame,
    link_hashkey: str,
    foreign_hashkeys: Sequence[str],
    existing: DataFrame | None = None,
    small_batch: bool = False,
    repeated: bool = False,
) -> DataFrame:
    """Earliest row per link key that the link lacks; rows missing a foreign key are dropped."""
    known = staged.dropna(subset=[link_hashkey, *foreign_hashkeys])
    rows = _earliest(known, link_hashkey, foreign_hashkeys, repeated)
    return rows if existing is None else absent(rows, existing, [link_hashkey], small_batch)


def satellite(
    staged: DataFrame,
    parent_hashkey: str,
    hashdiff: str,
    payload: Sequence[str],
    existing: DataFrame | None = None,
    tie_break: Sequence[str] = (),
    high_water_mark: bool = False,
    slice_unit: str | None = "month",
    small_batch: bool = False,
) -> DataFrame:
    """Payload changes per parent in load-time order, after what the target already holds.

    At most one row per (parent, load time): the greatest by ``tie_break``, then hashdiff.
    Rows at or before the parent's last loaded time were loaded earlier and add nothing.
    ``slice_unit=None`` is for parents with few rows each: the whole load is then one shuffle.
    """
    columns = [parent_hashkey, hashdiff, LDTS, RSRC, *payload]
    extra = [name for name in tie_break if name not in columns]
    rows = staged.filter(F.col(parent_hashkey).isNotNull()).select(*columns, *extra)
    if existing is not None and high_water_mark:
        mark = existing.agg(F.max(LDTS)).scalar()
        rows = rows.filter(mark.isNull() | (F.col(LDTS) > mark))
    if slice_unit is None:
        rows = rows.repartition(parent_hashkey)
    elif len(tie_break) == 1 and tie_break[0] not in columns:
        grouped = rows.groupBy(*columns).agg(F.max(tie_break[0]).alias(tie_break[0]))
        rows = grouped.select(*rows.columns)
    rows = latest_by_key(rows, [parent_hashkey, LDTS], [*tie_break, hashdiff]).select(*columns)
    loaded = F.lit(None).cast("string")
    if existing is not None:
        if small_batch:
            existing = existing.join(staged.select(parent_hashkey), parent_hashkey, "left_semi")
        last = existing.groupBy(parent_hashkey).agg(
            F.max(LDTS).alias("__last_ldts"), F.max_by(hashdiff, LDTS).alias("__last_diff")
        )
        rows = rows.join(last, parent_hashkey, "left").filter(
            F.col("__last_ldts").isNull() | (F.col(LDTS) > F.col("__last_ldts"))
        )
        loaded = F.col("__last_diff")
    ordered = with_previous(
        rows, [parent_hashkey], [LDTS], F.col(hashdiff), "__previous", slice_unit
    )
    previous = F.col("__previous")
    before = F.when(previous.isNotNull(), previous[VALUE]).otherwise(loaded)
    return ordered.filter(~F.col(hashdiff).eqNullSafe(before)).select(*columns)


def satellite_intervals(
    sat: DataFrame,
    parent_hashkey: str,
    valid_to: str = "valid_to",
    slice_unit: str | None = "month",
) -> DataFrame:
    """End-date each satellite row at the parent's next load time."""
    return with_next_start(sat, [parent_hashkey], LDTS, valid_to, slice_unit)


def current_rows(sat: DataFrame, parent_hashkey: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest satellite row per parent."""
    return latest_by_key(sat, [parent_hashkey], [LDTS, *tie_break], final_tie=not tie_break)


def _located(
    keys: DataFrame,
    sat: DataFrame,
    name: str,
    hashkey: str,
    snapshots: Column,
    slice_unit: str | None,
) -> DataFrame:
    """For every key and snapshot the load time of the satellite row in force, or NULL.

    Each version claims the snapshots between its load time and the next one; the time before
    the first version is claimed by a placeholder. No range join and no pair that is not output.
    """
    versions = satellite_intervals(sat.select(hashkey, LDTS), hashkey, "__until", slice_unit)
    first = sat.groupBy(hashkey).agg(F.min(LDTS).alias("__until"))
    unversioned = keys.join(first, hashkey, "left").select(
        hashkey, F.lit(None).cast("timestamp").alias(LDTS), "__until"
    )
    spans = versions.join(keys, hashkey, "left_semi").unionByName(unversioned)
    inside = lambda moment: (
        (F.col(LDTS).isNull() | (moment >= F.col(LDTS)))
        & (F.col("__until").isNull() | (moment < F.col("__until")))
    )
    return spans.withColumn("__all", snapshots).select(
        hashkey,
        F.explode(F.filter("__all", inside)).alias("sdts"),
        F.when(F.col(LDTS).isNotNull(), F.col(hashkey)).alias(f"hk_{name}"),
        F.col(LDTS).alias(f"ldts_{name}"),
    )


def pit(
    hub_rows: DataFrame,
    hashkey: str,
    satellites: Mapping[str, DataFrame],
    snapshots: DataFrame,
    trigger: str,
    dimension_key: str,
    slice_unit: str | None = "month",
) -> DataFrame:
    """Hub keys by triggered snapshots, with the satellite row in force at each.

    The calendar has at most one row per day, so it travels as one sorted array.
    """
    active = (
        snapshots.filter(F.col(trigger)).agg(F.sort_array(F.collect_list("sdts"))).scalar()
    )
    keys = hub_rows.filter(F.col(hashkey).isNotNull()).select(hashkey)
    result = None
    for name, sat in satellites.items():
        located = _located(keys, sat, name, hashkey, active, slice_unit)
        result = located if result is None else result.join(located, [hashkey, "sdts"], "inner")
    digest = F.md5(F.concat(F.col(hashkey), F.col("sdts").cast("string")))
    return result.select(digest.alias(dimension_key), "*")


def clean_pit(pit_rows: DataFrame, snapshots: DataFrame, trigger: str = "is_active") -> DataFrame:
    """Drop snapshots that are no longer retained."""
    return pit_rows.join(snapshots.filter(F.col(trigger)).select("sdts"), "sdts", "left_semi")


def read_as_of(
    pit_rows: DataFrame, sat: DataFrame, name: str, hashkey: str
) -> DataFrame:
    """Payload in force at each snapshot, read through the point-in-time table."""
    payload = [column for column in sat.columns if column not in (hashkey, LDTS, RSRC)]
    versions = sat.select(
        F.col(hashkey).alias(f"hk_{name}"), F.col(LDTS).alias(f"ldts_{name}"), *payload
    )
    return pit_rows.join(versions, [f"hk_{name}", f"ldts_{name}"], "left")
