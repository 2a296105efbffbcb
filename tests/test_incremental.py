"""Totals, merged streams and live prices that are kept current batch by batch."""

import pytest
from frames import at, plan, rows
from pyspark.sql import functions as F

from tidewatt.operators.asof import asof_join, effective_intervals
from tidewatt.operators.rollup import periodic_totals
from tidewatt.plans import incremental
from tidewatt.plans.incremental import IncrementalTotals
from tidewatt.registry import queries
from tidewatt.sinks.tables import SnapshotTable
from tidewatt.streaming.merged import HourlyMerge, LivePricing, run_batches

SCHEMA = "id string, meter string, moment timestamp, kwh decimal(10,2), version int, is_void boolean, extra int"


def totals(tmp_path, **more):
    return IncrementalTotals(
        str(tmp_path / "totals"), "id", "moment", (("meter", "string"),), (("kwh", "decimal(10,2)"),), ("version",), **more
    )


def batch(spark, *data):
    full = [(i, m, at(t) if t else None, None if k is None else str(k), v, void, 7) for i, m, t, k, v, void in data]
    return spark.createDataFrame(full, SCHEMA.replace("kwh decimal(10,2)", "kwh string")).withColumn("kwh", F.col("kwh").cast("decimal(10,2)"))


def rebuilt(final):
    whole = periodic_totals(final, "moment", ["meter"], {"kwh": "kwh"}, "n_rows")
    first = final.agg(F.date_trunc("hour", F.min("moment"))).scalar()
    return rows(whole.withColumn("period_start", F.greatest(F.date_trunc("hour", "period_start"), first)), "period_grain", "period_start", "meter", "kwh", "n_rows")


def current(kept, spark):
    return rows(kept.read(spark), "period_grain", "period_start", "meter", "kwh", "n_rows")


FIRST = [
    ("1", "a", "2025-12-30T10:10:00", 1, 1, None),
    ("2", "a", "2025-12-30T10:50:00", 2, 1, None),
    ("3", "b", "2026-01-01T00:00:00", 4, 1, None),
    ("4", "b", "2026-01-05T23:59:59", 8, 1, False),
]


def test_late_corrected_moved_and_void_rows(spark, tmp_path):
    kept = totals(tmp_path)
    kept.load(batch(spark, *FIRST))
    assert current(kept, spark) == rebuilt(batch(spark, *FIRST))
    second = [
        ("3", "b", "2026-01-03T07:00:00", 5, 2, None),  # the only row of its day moves away
        ("2", "a", "2025-12-30T10:50:00", 3, 3, None),  # corrected twice in one batch
        ("2", "a", "2025-12-30T10:50:00", 9, 2, None),
        ("5", "a", "2025-12-28T01:00:00", 6, 1, None),  # late: before all others
        ("4", "b", "2026-01-05T23:59:59", 8, 2, True),  # taken out
    ]
    report = kept.load(batch(spark, *second))
    final = batch(spark, FIRST[0], second[0], second[1], second[3])
    assert current(kept, spark) == rebuilt(final)
    # Hours: b's old and new one, a's corrected, a's late, b's emptied.
    assert (report.touched_hours, report.rows_summed) == (5, 4)
    back = kept.load(batch(spark, ("3", "b", "2026-01-01T00:30:00", 5, 3, None), ("4", "b", "2026-01-05T23:00:00", 1, 3, None)))
    assert back.touched_hours == 3
    final = batch(spark, FIRST[0], second[1], second[3], ("3", "b", "2026-01-01T00:30:00", 5, 3, None), ("4", "b", "2026-01-05T23:00:00", 1, 3, None))
    assert current(kept, spark) == rebuilt(final)


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    kept = totals(tmp_path, fixed_moment=True)
    for _ in range(2):
        kept.load(batch(spark, *FIRST))
    assert current(kept, spark) == rebuilt(batch(spark, *FIRST))
    kept.load(batch(spark))
    assert current(kept, spark) == rebuilt(batch(spark, *FIRST))


@pytest.mark.parametrize("stop", [1, 2, 3, 4])
def test_a_load_that_stops_is_repeated(spark, tmp_path, monkeypatch, stop):
    """Whatever table write fails, the same batch again ends where an undisturbed run ends."""
    kept = totals(tmp_path)
    kept.load(batch(spark, *FIRST))
    second = batch(spark, ("1", "a", "2026-01-02T10:10:00", 7, 2, None), ("6", "c", "2026-01-02T11:00:00", 1, 1, None))
    replace, calls = SnapshotTable.replace, []

    def failing(self, session, frame):
        calls.append(self.path)
        if len(calls) == stop:
            raise OSError("lost")
        replace(self, session, frame)

    monkeypatch.setattr(SnapshotTable, "replace", failing)
    with pytest.raises(OSError, match="lost"):
        kept.load(second)
    monkeypatch.setattr(SnapshotTable, "replace", replace)
    kept.load(second)
    final = batch(spark, ("1", "a", "2026-01-02T10:10:00", 7, 2, None), *FIRST[1:], ("6", "c", "2026-01-02T11:00:00", 1, 1, None))
    assert current(kept, spark) == rebuilt(final)


def merged(tmp_path):
    return HourlyMerge(str(tmp_path / "hours"), "moment", (("meter", "string"),), (("kwh", "decimal(38,2)"),))


def by_hour(frame):
    return rows(frame.groupBy(F.date_trunc("hour", "moment").alias("h"), "meter").agg(F.sum("kwh").cast("decimal(38,2)").alias("kwh"), F.count("*").alias("n")))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    hourly = merged(tmp_path)
    one, two = batch(spark, *FIRST), batch(spark, ("9", "a", "2025-12-30T10:59:59", 4, 1, None), ("8", None, None, 5, 1, None), ("7", "z", "1999-01-01T00:00:00", None, 1, None))
    for frame, epoch in ((one, 0), (two, 1), (two, 1), (one, 0)):
        hourly.merge(frame, epoch)
    assert rows(hourly.read(spark), "reading_hour", "meter", "kwh", "reading_count") == by_hour(one.union(two))


def test_a_merge_that_stops_is_replayed_once(spark, tmp_path, monkeypatch):
    hourly = merged(tmp_path)
    hourly.merge(batch(spark, *FIRST), 0)
    write, calls = SnapshotTable._write, []

    def failing(self, frame, path, mode, dynamic=False):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        write(self, frame, path, mode, dynamic)

    more = batch(spark, ("9", "a", "2025-12-30T10:59:59", 4, 1, None))
    monkeypatch.setattr(SnapshotTable, "_write", failing)
    with pytest.raises(OSError, match="lost"):
        hourly.merge(more, 1)
    monkeypatch.setattr(SnapshotTable, "_write", write)
    hourly.merge(more, 1)
    assert rows(hourly.read(spark), "reading_hour", "meter", "kwh", "reading_count") == by_hour(batch(spark, *FIRST).union(more))


def test_stream_of_files_out_of_order(spark, tmp_path):
    source, hourly = str(tmp_path / "in"), merged(tmp_path)
    parts = [batch(spark, *FIRST[2:]), batch(spark, *FIRST[:2]), batch(spark, ("9", "b", "2026-01-01T00:30:00", 3, 1, None))]
    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(source)
    run = lambda: run_batches(
        spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(source), hourly.merge, str(tmp_path / "cp")
    )
    run()
    parts[2].coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert rows(hourly.read(spark), "reading_hour", "meter", "kwh", "reading_count") == by_hour(parts[0].union(parts[1]).union(parts[2]))


def live(spark, tmp_path, prices):
    kept = IncrementalTotals(
        str(tmp_path / "totals"), "id", "moment", (("meter", "string"), ("zone", "string")), (("kwh", "decimal(10,2)"), ("cost", "decimal(12,4)")), fixed_moment=True
    )

    def tariffs(session):
        frame = session.createDataFrame([(z, "r", at(t), p) for z, t, p in prices], "zone string, region string, start timestamp, price double")
        return effective_intervals(frame, ["zone"], "start", "end").withColumn("price", F.col("price").cast("decimal(6,2)"))

    return LivePricing(
        str(tmp_path / "live"), kept,
        (("id", "string"), ("meter", "string"), ("zone", "string"), ("region", "string"), ("moment", "timestamp"), ("kwh", "decimal(10,2)")),
        tariffs, lambda frame: frame.withColumn("cost", F.col("kwh") * F.col("price")), ("zone",), ("region",), "start", "end",
    ), tariffs


def test_tariffs_that_change_while_the_stream_runs(spark, tmp_path):
    prices = [("x", "2026-01-01T00:00:00", 1.0), ("x", "2026-01-03T00:00:00", 2.0), ("y", "2026-01-02T00:00:00", 3.0)]
    plan, tariffs = live(spark, tmp_path, prices)
    readings = spark.createDataFrame(
        [(f"{z}{d}{h}", "m", z, "r", at(f"2026-01-0{d}T{h:02d}:30:00"), "1") for z in "xy" for d in range(1, 6) for h in (0, 12)],
        "id string, meter string, zone string, region string, moment timestamp, kwh string",
    )
    first, rest = readings.where("id < 'x40'"), readings.where("id >= 'x40'")

    def expected(taken):
        joined = asof_join(taken, tariffs(spark), by=["zone"], also=["region"], left_ts="moment", valid_from="start", valid_to="end")
        joined = joined.withColumn("kwh", F.col("kwh").cast("decimal(10,2)")).withColumn("cost", (F.col("kwh") * F.col("price")).cast("decimal(38,4)"))
        hour = F.date_trunc("hour", "moment").alias("h")
        return rows(joined.groupBy(hour, "meter", "zone").agg(F.sum("kwh").cast("decimal(38,2)"), F.sum("cost").cast("decimal(38,4)"), F.count("*")))

    def found():
        return rows(plan.totals.read_hours(spark), "period_hour", "meter", "zone", "kwh", "cost", "n_rows")

    plan.process(first)
    assert found() == expected(first)
    # A tariff inside an interval: only the hours behind it are priced again.
    prices.append(("x", "2026-01-02T12:00:00", 5.0))
    report = plan.process(rest.where("id < 'y'"))
    assert found() == expected(readings.where("id < 'y'"))
    assert report.touched_hours == rest.where("id < 'y'").count() + 1
    plan.process(rest)
    assert found() == expected(readings)
    # Nothing new: nothing is priced. Then a corrected price, and one that is withdrawn.
    assert plan.process(readings.limit(0)).touched_hours == 0
    prices[1] = ("x", "2026-01-03T00:00:00", 2.5)
    assert plan.process(readings.limit(0)).touched_hours == 6
    assert found() == expected(readings)
    prices.pop(2)
    plan.process(readings.limit(0))
    assert found() == expected(readings) and not any(r[2] == "y" for r in found())


def test_touched_keys_and_rows_meet_in_one_shuffle(spark, tmp_path, monkeypatch):
    kept, made = totals(tmp_path), []
    stored = incremental.stored

    def seen(frame, purpose):
        if purpose == "totals":
            made.append(plan(frame))
        return stored(frame, purpose)

    monkeypatch.setattr(incremental, "stored", seen)
    # A row without a moment and one without a group: keys may be NULL.
    data = batch(spark, *FIRST, ("5", None, "2025-12-30T10:20:00", 3, 1, None), ("6", "a", None, None, 1, None))
    kept.load(data)
    assert len(made) == 3 and all("Join" not in p and p.count("Exchange hashpartitioning") == 1 for p in made)
    hour = F.date_trunc("hour", "moment").alias("h")
    expected = data.groupBy(hour, "meter").agg(F.sum("kwh").cast("decimal(38,2)").alias("kwh"), F.count("*").alias("n"))
    found = kept.read_hours(spark).select("period_hour", "meter", "kwh", "n_rows")
    assert rows(found) == rows(expected)


def test_a_reading_meets_changed_spans_only_if_it_was_there_before(spark, tmp_path, monkeypatch):
    """The batch's own readings are priced anyway; what is priced is computed once, before the join."""
    prices = [("x", "2026-01-01T00:00:00", 1.0), ("x", "2026-01-03T00:00:00", 2.0)]
    live_pricing, _ = live(spark, tmp_path, prices)
    covered, met = LivePricing._covered, []

    def seen(self, rows, intervals, how="inner"):
        met.append((how, rows.count(), "Join" in plan(rows)))
        return covered(self, rows, intervals, how)

    monkeypatch.setattr(LivePricing, "_covered", seen)
    readings = spark.createDataFrame(
        [(f"{d}", "m", "x", "r", at(f"2026-01-0{d}T12:00:00"), "1") for d in range(1, 6)],
        "id string, meter string, zone string, region string, moment timestamp, kwh string",
    )
    live_pricing.process(readings.where("id <= '3'"))
    assert met == [("inner", 0, False), ("inner", 0, False), ("left", 3, False)]
    met.clear()
    prices.append(("x", "2026-01-02T00:00:00", 5.0))
    # 3 comes again and 4 and 5 are new; 2 is in a folder that the late tariff touches, 1 is not.
    report = live_pricing.process(readings.where("id >= '3'"))
    assert met == [("inner", 1, False), ("inner", 1, False), ("left", 4, False)]
    assert report.touched_hours == 4
    costs = {r.period_hour.day: r.cost for r in live_pricing.totals.read_hours(spark).collect()}
    assert costs == {1: 1, 2: 5, 3: 2, 4: 2, 5: 2}


def test_billed_readings_do_not_meet_all_tariffs_of_their_hour(spark, small):
    billed = queries._billed(spark, small)
    assert "__level" in plan(billed) and "__bucket" not in plan(billed)
    assert rows(billed) == rows(queries._priced(spark, small, "bucket"), *billed.columns)
