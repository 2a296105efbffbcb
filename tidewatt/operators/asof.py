"""Effective-dated join: each left row meets the right interval that covers its time.

Equality holds only on a few keys (for example 51 states), so a plain join would test every
reading against every price of its state. Three exact plans avoid that:

``bucket``   closed intervals are spread over the time buckets they cover and joined on (keys,
             bucket); the open interval of a key, at most one, is joined on the keys. Spark picks
             the join by its own size limit, and adaptive execution splits hot partitions, as
             every left row is matched on its own.
``shuffle``  the same with sort-merge joins throughout.
``dyadic``   a closed interval is covered by a few aligned blocks of a power of two, of about its
             own length, whatever that is; the moments of the left rows are joined on (keys, level,
             block), once for each length class that their key has. For intervals of any length,
             from seconds to decades, next to each other.
``carry``    both sides are merged into one timeline and the last interval is carried
             forward; for interval sets that are dense inside one bucket.

None of them measures its input, and all give the same rows. The first two also run on a stream
of left rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.operators.timeline import with_carried, with_next_start

BUCKET = "__bucket"
PREFIX = "__right_"
CLOSED, OPEN = "__closed", "__open"
AT, LEVEL, BLOCK = "__at", "__level", "__block"
#: Levels differ by this many powers of two: an interval has at most 2**3 + 1 blocks.
LEVEL_STEP = 3


def effective_intervals(
    frame: DataFrame, by: Sequence[str], valid_from: str, valid_to: str, slice_unit: str = "day"
) -> DataFrame:
    """Close each row at the next row's start within the key; the last one stays open."""
    return with_next_start(frame, by, valid_from, valid_to, slice_unit)


def _spread(closed: DataFrame, valid_from: str, valid_to: str, bucket: str) -> DataFrame:
    """One row per time bucket a closed interval covers."""
    first = F.date_trunc(bucket, F.col(valid_from))
    last = F.date_trunc(bucket, F.col(valid_to) - F.expr("interval 1 microsecond"))
    return closed.filter(F.col(valid_to) > F.col(valid_from)).withColumn(
        BUCKET, F.explode(F.sequence(first, last, F.expr(f"interval 1 {bucket}")))
    )


def _bucket_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    also: Sequence[str],
    left_ts: str,
    valid_from: str,
    valid_to: str,
    bucket: str,
    how: str,
    hint: str | None,
) -> DataFrame:
    keys = (*by, *also)
    kept = [name for name in right.columns if name not in keys]

    def matched(rows: DataFrame, name: str, *extra: str) -> DataFrame:
        found = rows.select(
            *[F.col(key).alias(PREFIX + key) for key in (*keys, *extra)],
            F.struct(*kept).alias(name),
        )
        return found.hint(hint) if hint else found

    closed = right.filter(F.col(valid_to).isNotNull())
    spread = matched(_spread(closed, valid_from, valid_to, bucket), CLOSED, BUCKET)
    still_open = matched(right.filter(F.col(valid_to).isNull()), OPEN)
    stamped = left.withColumn(BUCKET, F.date_trunc(bucket, F.col(left_ts)))
    moment = F.col(left_ts)

    def same(rows: DataFrame) -> Column:
        return reduce(Column.__and__, [F.col(key) == rows[PREFIX + key] for key in keys])

    inside = (moment >= F.col(CLOSED)[valid_from]) & (moment < F.col(CLOSED)[valid_to])
    in_bucket = same(spread) & (F.col(BUCKET) == spread[PREFIX + BUCKET]) & inside
    names = [PREFIX + key for key in (*keys, BUCKET)]
    joined = stamped.join(spread, in_bucket, "left").drop(*names)
    joined = joined.join(still_open, same(still_open) & (moment >= F.col(OPEN)[valid_from]), "left")
    covering = F.coalesce(CLOSED, OPEN)
    if how == "inner":
        joined = joined.filter(covering.isNotNull())
    return joined.select(*left.columns, *[covering[name].alias(name) for name in kept])


def _shifted(moment: Column, level: Column) -> Column:
    """Number of the aligned block of 2**level microseconds that holds a moment."""
    return F.call_function("shiftright", moment, level)


def with_level(
    closed: DataFrame, valid_from: str, valid_to: str, step: int = LEVEL_STEP
) -> DataFrame:
    """Non-empty closed intervals with their level: blocks are at most as long as the interval.

    The level is a multiple of ``step``, so a block is longer than a 2**step-th of the interval.
    """
    length = F.unix_micros(valid_to) - F.unix_micros(valid_from)
    level = (F.floor(F.log2(length) / step) * step).cast("int")
    return closed.filter(F.col(valid_to) > F.col(valid_from)).withColumn(LEVEL, level)


def dyadic_blocks(
    closed: DataFrame, valid_from: str, valid_to: str, step: int = LEVEL_STEP
) -> DataFrame:
    """One row per aligned block that an interval touches: at most 2**step + 1, however long it is.

    Disjoint intervals of one level are as long as a block at least, so at most two of them touch
    the same block.
    """
    first = _shifted(F.unix_micros(valid_from), F.col(LEVEL))
    last = _shifted(F.unix_micros(valid_to) - 1, F.col(LEVEL))
    levelled = with_level(closed, valid_from, valid_to, step)
    return levelled.withColumn(BLOCK, F.explode(F.sequence(first, last)))


def _dyadic_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    also: Sequence[str],
    left_ts: str,
    valid_from: str,
    valid_to: str,
    how: str,
    step: int,
) -> DataFrame:
    """Only the distinct moments of a key meet the blocks; whole rows are joined once, at the end.

    A moment is carried at the levels that its own key has, not at all levels there are.
    """
    keys = [*by, *also]
    kept = [name for name in right.columns if name not in keys]
    moments = left.select(*keys, F.col(left_ts).alias(AT)).dropna().distinct()
    closed = right.filter(F.col(valid_to).isNotNull())
    levels = with_level(closed, valid_from, valid_to, step).select(*by, LEVEL).distinct()
    blocks = dyadic_blocks(closed, valid_from, valid_to, step).select(
        *keys, LEVEL, BLOCK, F.struct(*kept).alias(CLOSED)
    )
    placed = moments.join(levels, list(by)).withColumn(
        BLOCK, _shifted(F.unix_micros(AT), F.col(LEVEL))
    )
    inside = (F.col(AT) >= F.col(CLOSED)[valid_from]) & (F.col(AT) < F.col(CLOSED)[valid_to])
    in_block = placed.join(blocks, [*keys, LEVEL, BLOCK]).filter(inside)
    open_ones = right.filter(F.col(valid_to).isNull()).select(*keys, F.struct(*kept).alias(CLOSED))
    after_open = moments.join(open_ones, keys).filter(F.col(AT) >= F.col(CLOSED)[valid_from])
    covering = in_block.select(*keys, AT, CLOSED).unionByName(after_open.select(*keys, AT, CLOSED))
    found = covering.select(*[F.col(key).alias(PREFIX + key) for key in keys], AT, CLOSED)
    on = [left[key] == found[PREFIX + key] for key in keys] + [left[left_ts] == found[AT]]
    return left.join(found, reduce(Column.__and__, on), how).select(
        *[left[name] for name in left.columns], *[F.col(CLOSED)[name].alias(name) for name in kept]
    )


def _carry_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    also: Sequence[str],
    left_ts: str,
    valid_from: str,
    valid_to: str,
    how: str,
    slice_unit: str,
    salts: int,
) -> DataFrame:
    """Left rows of a key are salted and the intervals repeated per salt, so a hot key is shared
    by ``salts`` x (number of slices) tasks."""
    payload = [name for name in right.columns if name not in by]
    kept = [name for name in payload if name not in also]
    left_row = F.struct(*[F.col(name) for name in left.columns])
    right_row = F.struct(*[F.col(name) for name in payload])
    salt = F.pmod(F.xxhash64(*[F.col(name) for name in left.columns]), F.lit(salts)).cast("int")
    right_known = right.dropna(subset=list(by))
    keys = [F.col(name) for name in by]
    left_line = left.select(
        *keys, salt.alias("__salt"), F.col(left_ts).alias("__at"), F.lit(1).alias("__side"),
        left_row.alias("__left"),
    )
    right_line = right_known.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"),
        F.col(valid_from).alias("__at"),
        F.lit(0).alias("__side"),
        right_row.alias("__right"),
    )
    line = left_line.unionByName(right_line, allowMissingColumns=True)
    carried = with_carried(
        line, [*by, "__salt"], ["__at", "__side"], F.col("__right"), "__match", slice_unit
    ).filter(F.col("__side") == 1)
    covers = F.col("__match").isNotNull() & (
        F.col(f"__match.{valid_to}").isNull() | (F.col("__at") < F.col(f"__match.{valid_to}"))
    )
    for name in also:
        covers &= F.col(f"__match.{name}") == F.col(f"__left.{name}")
    covers = F.coalesce(covers, F.lit(False))
    if how == "inner":
        carried = carried.filter(covers)
    return carried.select(
        "__left.*", *[F.when(covers, F.col(f"__match.{name}")).alias(name) for name in kept]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_ts: str,
    valid_from: str,
    valid_to: str,
    also: Sequence[str] = (),
    how: str = "inner",
    strategy: str = "bucket",
    bucket: str = "hour",
    carry_slice: str = "day",
    salts: int = 8,
    level_step: int = LEVEL_STEP,
) -> DataFrame:
    """Join on ``by``, ``also`` and ``valid_from <= left_ts < valid_to`` (open when NULL).

    Intervals of one ``by`` key must be disjoint (``effective_intervals`` makes them so).
    ``also`` is an equality on the covering interval, never a reason to look further back.
    ``how`` is ``inner`` or ``left``. Left rows may lie anywhere in time.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if strategy not in ("bucket", "shuffle", "dyadic", "carry"):
        raise ValueError("strategy must be bucket, shuffle, dyadic or carry")
    if strategy == "dyadic":
        return _dyadic_join(
            left, right, by, also, left_ts, valid_from, valid_to, how, level_step
        )
    if strategy == "carry":
        return _carry_join(
            left, right, by, also, left_ts, valid_from, valid_to, how, carry_slice, salts
        )
    hint = "merge" if strategy == "shuffle" else None
    return _bucket_join(
        left, right, by, also, left_ts, valid_from, valid_to, bucket, how, hint
    )
