"""Conversation rows: numbering and running sums that no single long conversation can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.common import kept

#: Rows of one key that a window sees at a time in ``running``.
SPAN = 1024

#: crc32 of a short ASCII text: every byte is mixed in, then eight bits are shifted out.
CRC32_SQL = """xor(list_reduce(flatten([[4294967295::BIGINT]] || list_transform(string_split({text}, ''),
    lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""


def content_digest(role: Column, text: Column) -> Column:
    """MD5 of a turn's role and text; the length in front keeps the two apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def numbered(rows: DataFrame, key: str, order: list[Column], purpose: str) -> DataFrame:
    """``rows`` with ``pos``, the place of a row within its ``key``, from 0, along ``order``.

    Rows are cut into ranges of (key, order) and stored with the number of their range. A range
    holds a bounded share of the table whatever the key, so the windows run per (key, range); the
    rows of a key in earlier ranges are added from one small row per key and range.
    """
    cut = kept(rows.repartitionByRange(key, *order).withColumn("__range", F.spark_partition_id()), purpose)
    within = F.row_number().over(Window.partitionBy(key, "__range").orderBy(*order))
    sizes = cut.groupBy(key, "__range").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(key, "__range", F.sum("__n").over(earlier).alias("__before")).where("__before > 0")
    placed = cut.withColumn("__within", within).join(before, [key, "__range"], "left")
    place = F.col("__within") - 1 + F.coalesce("__before", F.lit(0))
    return placed.withColumn("pos", place.cast("long")).drop("__range", "__within", "__before")


def running(rows: DataFrame, keys: list[str], place: str, values: dict[str, str], span: int = SPAN) -> DataFrame:
    """``rows`` with sums over the rows of the key at smaller places, and over the whole key.

    ``values`` maps a column to the name of its sum; the whole sum gets the suffix ``_all``. Places
    are numbers from 0 without much of a gap. Windows see ``span`` places of a key at a time; one
    row for each span is summed along the key.
    """
    spans = rows.withColumn("__span", F.floor(F.col(place) / span).cast("long"))
    by_span = spans.groupBy(*keys, "__span").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    along = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = by_span.select(
        *keys,
        "__span",
        *[F.coalesce(F.sum(f"__{v}").over(along), F.lit(0)).alias(f"__before_{v}") for v in values],
        *[F.sum(f"__{v}").over(whole).alias(f"{name}_all") for v, name in values.items()],
    )
    inside = Window.partitionBy(*keys, "__span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = spans.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__inside_{v}") for v in values])
    joined = local.join(offsets, [*keys, "__span"])
    for v, name in values.items():
        joined = joined.withColumn(name, F.col(f"__inside_{v}") + F.col(f"__before_{v}"))
    return joined.drop("__span", *[f"__{part}_{v}" for part in ("inside", "before") for v in values])
