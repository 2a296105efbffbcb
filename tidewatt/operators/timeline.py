"""Previous, next and carried-forward values along a keyed timeline.

A plain window over the key sorts all rows of one key in one task. Here the timeline of a key
is cut into calendar slices: the window runs per (key, slice), and only one row per slice takes
part in a second window that links the slices of a key. The result is the same; the largest task
is one slice of one key. ``slice_unit=None`` asks for the plain window, for keys that are known
to have few rows each (a primary key, for example).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = "__slice"
NEAR = "__near"
HAS = "__has"
SHARED = "__shared"
VALUE = "value"
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _linked(
    frame: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slice_unit: str | None,
    step: Callable[[Column], Column],
    passed_on: Callable[[Column], Column],
) -> DataFrame:
    """``step`` is lag or lead; ``passed_on`` picks the value a slice hands to its neighbour.

    The neighbour's value comes wrapped in a struct: NULL means there is no neighbour, a NULL
    field that the neighbour has none. Rows at the edge of a slice have no neighbour inside it.
    They alone go through the second window. Both branches read the same shuffle.
    """
    there = F.lit(1)

    def wrapped(exists: Column, found: Column) -> Column:
        return F.when(exists.isNotNull(), F.struct(found.alias(VALUE)))

    if slice_unit is None:
        window = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn(name, wrapped(step(there).over(window), step(value).over(window)))
    window = Window.partitionBy(*by, SLICE).orderBy(*order)
    across = Window.partitionBy(*by).orderBy(SLICE)
    sliced = frame.withColumn(SLICE, F.date_trunc(slice_unit, F.col(order[0]))).withColumns(
        {
            HAS: step(there).over(window),
            NEAR: step(value).over(window),
            SHARED: passed_on(value).over(window.rowsBetween(*WHOLE)),
        }
    )
    inner = sliced.filter(F.col(HAS).isNotNull()).withColumn(name, wrapped(F.col(HAS), F.col(NEAR)))
    edge = sliced.filter(F.col(HAS).isNull()).withColumn(
        name, wrapped(step(there).over(across), step(F.col(SHARED)).over(across))
    )
    return inner.unionByName(edge).drop(SLICE, HAS, NEAR, SHARED)


def with_previous(
    frame: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slice_unit: str | None = "month",
) -> DataFrame:
    """Add a struct with the ``value`` of the preceding row of the key (NULL for the first row).

    ``order[0]`` is a non-NULL timestamp; the whole order must be unique within a key.
    """
    return _linked(frame, by, order, value, name, slice_unit, F.lag, F.last)


def with_next_start(
    frame: DataFrame, by: Sequence[str], start: str, name: str, slice_unit: str | None = "month"
) -> DataFrame:
    """Add the next row's ``start`` within the key: the open end of an effective interval."""
    linked = _linked(frame, by, [start], F.col(start), name, slice_unit, F.lead, F.first)
    return linked.withColumn(name, F.col(name)[VALUE])


def _last_known(value: Column, window: WindowSpec, upto: int) -> Column:
    return F.last(value, ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, upto)
    )


def with_carried(
    frame: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slice_unit: str = "day",
) -> DataFrame:
    """Add the most recent non-NULL ``value`` at or before each row.

    Any number of rows may open a slice without a value, so the slices are linked through a
    summary of one row each, joined back.
    """
    keys = [*by, SLICE]
    sliced = frame.withColumn(SLICE, F.date_trunc(slice_unit, F.col(order[0])))
    within = Window.partitionBy(*keys).orderBy(*order)
    across = Window.partitionBy(*by).orderBy(SLICE)
    latest = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    carried_in = (
        sliced.groupBy(*keys)
        .agg(latest.alias(SHARED))
        .withColumn(SHARED, _last_known(F.col(SHARED), across, -1))
    )
    return (
        sliced.withColumn(NEAR, _last_known(value, within, Window.currentRow))
        .join(carried_in, keys, "left")
        .withColumn(name, F.coalesce(NEAR, SHARED))
        .drop(SLICE, NEAR, SHARED)
    )
