"""Year, month, week, day and hour totals in one result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.calendar import GRAIN_NAMES, GRAINS, truncate

PERIOD = ("period_grain", "period_grain_order", "period_start")


def _grain_columns(name: str, order: int, moment: Column, data_start: Column) -> Column:
    return F.struct(
        F.lit(name).alias("period_grain"),
        F.lit(order).cast("smallint").alias("period_grain_order"),
        F.greatest(truncate(name, moment), data_start).alias("period_start"),
    )


def periodic_totals(
    frame: DataFrame,
    moment: str,
    by: Sequence[str],
    sums: Mapping[str, str],
    count: str | None = None,
    grains: Sequence[str] = GRAIN_NAMES,
    data_start: Column | None = None,
) -> DataFrame:
    """Sum ``sums`` (output name -> input column) per grain, period and ``by``.

    The five grains are not five passes: rows collapse to hours, hours to days, and only the
    day totals are spread over day, week, month and year. Sums are exact decimals, so the
    order of adding does not matter. A caller that needs some ``grains`` only gets no others made.
    ``period_start`` is never before the earliest ``moment`` of the whole frame, which is a scan of
    that one column, unless the caller knows it (``data_start``).

    A frame that is hash-partitioned by one of ``by`` is not shuffled at all: every level groups by
    that column too.
    """
    names = list(sums)
    first = [F.sum(column).alias(name) for name, column in sums.items()]
    if count is not None:
        names.append(count)
        first.append(F.count(F.lit(1)).alias(count))
    again = [F.sum(name).alias(name) for name in names]

    orders = dict(GRAINS)
    if strangers := set(grains) - set(orders):
        raise ValueError(f"no such grain: {', '.join(sorted(strangers))}")
    if data_start is None:
        data_start = frame.agg(F.min(moment)).scalar()

    def level(name: str, source: DataFrame, column: str) -> DataFrame:
        return source.groupBy(*by, truncate(name, F.col(column)).alias("__at")).agg(*again)

    def labelled(name: str, totals: DataFrame) -> DataFrame:
        return totals.select(
            _grain_columns(name, orders[name], F.col("__at"), data_start).alias("__period"), *by, *names
        )

    hours = frame.groupBy(*by, F.date_trunc("hour", F.col(moment)).alias("__at")).agg(*first)
    coarse = [name for name, _ in GRAINS if name != "Hour" and name in grains]
    parts = [labelled("Hour", hours)] if "Hour" in grains else []
    if len(coarse) == 1:
        parts.append(labelled(coarse[0], level(coarse[0], hours, "__at")))
    elif coarse:
        days = level("Day", hours, "__at")
        periods = F.array(*[_grain_columns(n, orders[n], F.col("__at"), data_start) for n in coarse])
        spread = days.select(F.explode(periods).alias("__period"), *by, *names)
        parts.append(spread.groupBy("__period", *by).agg(*again))
    return reduce(DataFrame.unionByName, parts).select(
        *[F.col(f"__period.{name}") for name in PERIOD], *by, *names
    )
