"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def first_by_key(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], final_tie: bool = True
) -> DataFrame:
    """First row of each key.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a
    key holding a large share of the rows costs one row per task, not one oversized task.
    ``final_tie`` closes the order with a full-row hash for inputs that may tie.
    """
    ordering = list(order)
    if final_tie or not ordering:
        ordering.append(F.xxhash64(*[F.col(name) for name in frame.columns]))
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return frame.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def latest_by_key(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], final_tie: bool = True
) -> DataFrame:
    """Row with the greatest ``order`` columns per key; NULLs count as smallest."""
    return first_by_key(frame, keys, [F.col(name).desc_nulls_last() for name in order], final_tie)


def absent(
    rows: DataFrame, existing: DataFrame, keys: Sequence[str], small_batch: bool = False
) -> DataFrame:
    """Rows whose keys ``existing`` lacks.

    With ``small_batch`` the existing keys are first reduced to those the rows ask for. When the
    rows are below Spark's broadcast limit the large table is then scanned, not shuffled.
    """
    known = existing.select(*keys)
    if small_batch:
        known = known.join(rows.select(*keys), list(keys), "left_semi")
    return rows.join(known, list(keys), "left_anti")
