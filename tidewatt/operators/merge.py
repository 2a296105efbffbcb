"""Insert-only and update-on-conflict merges as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.operators.keyed import absent, first_by_key, latest_by_key

ACTION = "__action"
INSERTED, UPDATED, KEPT = "inserted", "updated", "kept"


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep_first_by: Sequence[str] = (),
    small_batch: bool = False,
) -> DataFrame:
    """Source rows whose key the target lacks, one per key; the rest are ignored."""
    fresh = first_by_key(source, keys, [F.col(name).asc() for name in keep_first_by])
    return absent(fresh, target, keys, small_batch).select(*target.columns)


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], keep_first_by: Sequence[str] = ()
) -> DataFrame:
    return target.unionByName(rows_to_insert(target, source, keys, keep_first_by))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    keep_last_by: Sequence[str] = (),
) -> DataFrame:
    """Update ``update_columns`` where the key exists, insert where it does not.

    Other columns of an existing row stay as they are. The last source row per key wins.
    The result carries ``__action`` (inserted, updated or kept).
    """
    last = latest_by_key(source, keys, keep_last_by)
    old = target.select("*", F.lit(True).alias("__old")).alias("old")
    new = last.select(*target.columns, F.lit(True).alias("__new")).alias("new")
    on = [F.col(f"old.{name}") == F.col(f"new.{name}") for name in keys]
    has_old, has_new = F.col("old.__old").isNotNull(), F.col("new.__new").isNotNull()

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        take_new = has_new if name in update_columns else ~has_old
        return F.when(take_new, after).otherwise(before).alias(name)

    action = F.when(~has_old, INSERTED).when(has_new, UPDATED).otherwise(KEPT)
    return old.join(new, on, "full_outer").select(
        *[merged(name) for name in target.columns], action.alias(ACTION)
    )
