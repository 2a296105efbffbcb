"""Distinct counts from stored bitmaps against counts over the rows."""

from frames import at, plan, rows
from pyspark.sql import functions as F

from tidewatt.operators.distinct import NUMBER, bitmaps, dense_numbers, distinct_counts, merged_bitmaps
from tidewatt.plans.activity import ActivityStore


def store(tmp_path, by=(("zone", "string"),)):
    return ActivityStore(str(tmp_path / "activity"), "meter", "moment", by)


def readings(spark, *data):
    return spark.createDataFrame([(m, at(t) if t else None, z, 1) for m, t, z in data], "meter string, moment timestamp, zone string, extra int")


def test_numbers_are_dense_and_go_on(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k")).union(spark.sql("select cast(null as string)"))
    first = spark.createDataFrame(dense_numbers(keys.union(keys), "k").collect(), "k string, key_number bigint")
    assert sorted(r[NUMBER] for r in first.collect()) == list(range(1, 1001))
    more = spark.range(990, 1020).select(F.col("id").cast("string").alias("k"))
    assert sorted(r[NUMBER] for r in dense_numbers(more, "k", first).collect()) == list(range(1001, 1021))
    assert dense_numbers(more, "k", first.where("false")).count() == 30
    assert dense_numbers(keys.where("false"), "k").count() == 0


def test_many_buckets_and_unnumbered_rows(spark):
    frame = spark.range(100_000).select((F.col("id") % 70_000 + 1).alias(NUMBER), (F.col("id") % 3).alias("g"))
    frame = frame.union(spark.sql("select cast(null as bigint), 9L"))
    stored = bitmaps(frame, ["g"])
    assert rows(distinct_counts(stored, ["g"], "n")) == rows(
        frame.where("key_number is not null").groupBy("g").agg(F.count_distinct(NUMBER).alias("n"))
    )
    twice = merged_bitmaps(stored.union(stored), [])
    assert distinct_counts(twice, [], "n").first().n == 70_000
    assert distinct_counts(stored.where("false"), [], "n").first().n == 0


def test_loads_merge_and_repeat(spark, tmp_path):
    one = readings(spark, ("a", "2026-01-01T00:10:00", "x"), ("a", "2026-01-01T00:50:00", "x"), ("b", "2026-01-01T01:00:00", None), (None, "2026-01-01T01:00:00", "x"))
    two = readings(spark, ("a", "2026-01-02T00:00:00", "x"), ("c", "2026-01-01T00:20:00", "x"), ("d", None, "y"))
    activity = store(tmp_path)
    for batch in (one, two, two, one):
        activity.load(batch)
    whole = one.union(two).where("meter is not null")
    for grain in ("Hour", "Day", "Week", "Month", "Year"):
        expected = whole.groupBy(F.date_trunc(grain, "moment").alias("period_start"), "zone").agg(F.count_distinct("meter").alias("n"))
        found = activity.distinct(spark, grain, ["zone"], "n")
        assert set(found.select("period_start", "zone", "n").collect()) == set(expected.collect())
    assert activity.distinct(spark).first().n_distinct == 4
    assert {r.zone: r.n for r in activity.distinct(spark, None, ["zone"], "n").collect()} == {None: 1, "x": 2, "y": 1}


def test_a_range_reads_only_its_days(spark, tmp_path):
    activity = store(tmp_path)
    activity.load(readings(spark, *[("m", f"2026-01-{d:02d}T05:00:00", "x") for d in range(1, 20)]))
    found = activity.distinct(spark, "Day", (), "n", at("2026-01-03T00:00:00"), at("2026-01-05T05:00:00"))
    assert found.count() == 2
    assert "PartitionFilters: [isnotnull(activity_day" in plan(found)


def test_empty_load(spark, tmp_path):
    activity = store(tmp_path)
    activity.load(readings(spark))
    assert activity.distinct(spark, "Day").count() == 0
    assert activity.distinct(spark).first().n_distinct == 0
