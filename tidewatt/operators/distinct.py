"""Exact distinct counts that merge: bitmaps over dense key numbers.

A distinct count cannot be added up, so it normally goes back to the rows for every grain. A
bitmap per group says which keys are in it; the bitmap of a coarser group is the OR of those below,
and its bits are the distinct keys. Keys need small consecutive numbers for that, which
``dense_numbers`` deals out. Everything runs in Spark's own bitmap aggregates, with partial
aggregation before every shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.sinks.tables import stored

NUMBER, BUCKET, BITMAP = "key_number", "bitmap_bucket", "bitmap"


def dense_numbers(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, key_number) for the keys that ``known`` lacks, numbered on from its highest number.

    Numbers start at 1 and have no gaps. Keys are cut into ranges, counted per range, and numbered
    within it, so no task sees all of them; NULL gets no number. The ranges are stored before they
    are used twice: adaptive execution may otherwise cut them differently for each use.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
        first = F.coalesce(known.agg(F.max(NUMBER)).scalar(), first)
    ranged = stored(fresh.repartitionByRange(key).withColumn("__range", F.spark_partition_id()), "key-ranges")
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    # One row per range, whatever the number of keys.
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(key))
    return ranged.withColumn("__within", within).join(offsets, "__range").select(
        key, (first + F.col("__offset") + F.col("__within")).alias(NUMBER)
    )


def bitmaps(frame: DataFrame, by: Sequence[str], number: str = NUMBER) -> DataFrame:
    """(by, bitmap_bucket, bitmap): the keys of each group, 32,768 numbers to a bucket.

    Rows without a number are in no bitmap; a group of such rows only has no row.
    """
    known = frame.where(F.col(number).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP)
    )


def merged_bitmaps(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several loads: merging one twice changes nothing."""
    return frame.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_counts(frame: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by, ``name``): how many distinct keys each group of stored bitmaps holds."""
    counted = merged_bitmaps(frame, by).withColumn("__bits", F.bitmap_count(BITMAP))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("__bits"), F.lit(0)).cast("bigint").alias(name))
