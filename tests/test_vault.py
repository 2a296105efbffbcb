from datetime import UTC, datetime

from frames import at, rows
from pyspark.sql import functions as F

from tidewatt.functions.hashing import hash_diff, hash_key, surrogate_key
from tidewatt.operators.snapshots import retained_snapshots, snapshot_calendar
from tidewatt.operators.vault import (
    HashDiff,
    clean_pit,
    current_rows,
    hub,
    link,
    pit,
    read_as_of,
    satellite,
    stage,
)
from tidewatt.plans.vault_models import MODELS, PITS, load_pits, load_vault
from tidewatt.plans.stored_pit import StoredPit
from tidewatt.sources import supplied


def staged(spark, values):
    frame = spark.createDataFrame(
        [(k, p, at(f"2026-01-{d:02d}T00:00:00"), "file") for k, p, d in values],
        "k string, payload string, loaded timestamp, origin string",
    )
    hashes = {"hk": ["k"], "hl": ["k", "payload"], "hp": ["payload"], "hd": HashDiff(("payload",))}
    return stage(frame, "loaded", "origin", hashes)


def history(frame):
    return [r.payload for r in frame.orderBy("hk", "ldts").collect()]


def test_hash_normalisation(spark):
    frame = spark.createDataFrame(
        [(" ab ", "X", None), ("AB", "x", ""), (None, "", "  "), ("a", "b", "c")],
        "a string, b string, c string",
    )
    keys = [r[0] for r in frame.select(hash_key(["a", "b", "c"])).collect()]
    assert keys[0] == keys[1]
    assert keys[2] is None
    expected = frame.select(F.md5(F.lit("AB||X||^^"))).first()[0]
    assert keys[0] == expected
    diffs = [r[0] for r in frame.select(hash_diff(["a", "b", "c"])).collect()]
    assert diffs[0] != diffs[1]
    plain = frame.select(surrogate_key("a"), F.md5(F.lit(" ab "))).first()
    assert plain[0] == plain[1]


def test_hub_and_link(spark):
    frame = staged(spark, [("a", "x", 2), ("A ", "y", 1), ("b", "x", 3), (None, "z", 1), ("c", None, 1)])
    hubs = hub(frame, "hk", ["k"])
    assert rows(hubs, "k", "ldts") == [
        ("A ", "2026-01-01 00:00:00"), ("b", "2026-01-03 00:00:00"), ("c", "2026-01-01 00:00:00")
    ]
    links = link(frame, "hl", ["hk", "hp"])
    assert links.count() == 3
    assert hub(frame, "hk", ["k"], hubs).count() == 0
    assert link(frame, "hl", ["hk", "hp"], links.limit(1)).count() == 2


def test_satellite_keeps_changes_only(spark):
    frame = staged(spark, [("k", "A", 1), ("k", "A", 2), ("k", "B", 3), ("k", "A", 4), (None, "Z", 1)])
    for unit in ("day", "month", None):
        first = satellite(frame, "hk", "hd", ["payload"], slice_unit=unit)
        assert history(first) == ["A", "B", "A"]
        assert satellite(frame, "hk", "hd", ["payload"], first, slice_unit=unit).count() == 0
    more = staged(spark, [("k", "A", 5), ("k", "C", 6), ("n", "N", 6)])
    added = satellite(more, "hk", "hd", ["payload"], first)
    assert sorted(history(added)) == ["C", "N"]
    pruned = satellite(more, "hk", "hd", ["payload"], first, high_water_mark=True)
    assert sorted(history(pruned)) == ["C", "N"]


def test_satellite_with_wholly_null_payloads(spark):
    """Rows without any payload are changes too: at the start of a slice, inside, at its end."""
    values = [("a", "x", 1), ("a", None, 2), ("a", "y", 3), ("a", "y", 4), ("a", None, 5), ("a", None, 6), ("a", "y", 7),
              ("b", None, 1), ("b", "x", 2), ("b", None, 3), ("c", "x", 1), ("c", None, 28)]
    expected = [["x", None, "y", None, "y"], ["x", None], ["x", None]]

    def by_parent(frame):
        found = {}
        for row in frame.orderBy("ldts").collect():
            found.setdefault(row.hk, []).append(row.payload)
        return sorted(found.values(), key=len, reverse=True)

    for unit in ("day", "week", "month", None):
        found = satellite(staged(spark, values), "hk", "hd", ["payload"], slice_unit=unit)
        assert by_parent(found) == expected, unit
    early = satellite(staged(spark, [v for v in values if v[2] <= 2]), "hk", "hd", ["payload"])
    late = satellite(staged(spark, values), "hk", "hd", ["payload"], existing=early)
    assert by_parent(early.unionByName(late)) == expected


def test_one_row_per_load_time(spark):
    frame = staged(spark, [("k", "A", 1), ("k", "B", 1), ("k", "C", 2)]).withColumn(
        "seen", F.when(F.col("payload") == "A", 9).otherwise(1)
    )
    found = satellite(frame, "hk", "hd", ["payload"], tie_break=["seen"])
    assert history(found) == ["A", "C"]
    assert rows(current_rows(found, "hk"), "payload") == [("C",)]


def test_snapshot_retention(spark):
    as_of = datetime(2026, 8, 4, 6, tzinfo=UTC)
    flags = retained_snapshots(snapshot_calendar(spark, as_of), as_of)
    found = {str(r.sdts)[:10]: r for r in flags.collect()}
    assert len(found) == 2408
    active = {day for day, r in found.items() if r.is_active}
    assert [day for day, r in found.items() if r.is_latest] == ["2026-08-04"]
    assert {"2026-07-05", "2026-08-04"} <= active
    assert "2026-07-04" not in active
    assert "2026-06-29" in active and "2026-06-30" not in active
    assert "2026-02-09" in active and "2026-02-02" not in active
    assert "2023-09-01" in active and "2023-08-01" not in active
    assert {f"{y}-01-01" for y in range(2020, 2027)} <= active
    early = datetime(2026, 8, 4, 5, tzinfo=UTC)
    flags = retained_snapshots(snapshot_calendar(spark, early), early)
    assert rows(flags.filter("is_latest"), "sdts") == [("2026-08-03 06:00:00",)]


def test_pit_versions(spark):
    frame = staged(spark, [("k", "A", 2), ("k", "B", 4), ("other", "Z", 9)])
    sat = satellite(frame.filter("k = 'k'"), "hk", "hd", ["payload"])
    snapshots = spark.createDataFrame(
        [(at(f"2026-01-{d:02d}T00:00:00"), d != 5) for d in (1, 2, 3, 4, 5, 6)],
        "sdts timestamp, is_active boolean",
    )
    hubs = hub(frame, "hk", ["k"])
    for unit in ("month", "day", None):
        found = pit(hubs, "hk", {"sat": sat}, snapshots, "is_active", "hk_d", slice_unit=unit)
        key = hubs.filter("k = 'k'").first().hk
        versions = [
            r.ldts_sat.day if r.ldts_sat else None
            for r in found.filter(F.col("hk") == key).orderBy("sdts").collect()
        ]
        assert versions == [None, 2, 2, 4, 4]
        assert found.filter(F.col("hk") != key).filter("ldts_sat is null").count() == 5
    read = read_as_of(found, sat, "sat", "hk").filter(F.col("hk") == key).orderBy("sdts")
    assert [r.payload for r in read.collect()] == [None, "A", "A", "B", "B"]
    two = pit(hubs, "hk", {"one": sat, "two": sat}, snapshots, "is_active", "hk_d")
    assert two.count() == 10 and {"ldts_one", "ldts_two"} <= set(two.columns)
    kept = clean_pit(found, snapshots.filter("day(sdts) = 6"))
    assert kept.count() == 2


def test_reload_adds_nothing(spark, small):
    readings, prices = supplied.readings(spark, small), supplied.prices(spark, small)
    first = load_vault(readings, prices)
    again = load_vault(readings, prices, first)
    assert set(first) == set(MODELS)
    counts = {name: frame.count() for name, frame in again.items()}
    assert not any(counts.values()), counts
    cut = "event_time < timestamp'2024-01-20'"
    early = load_vault(readings.filter(cut), None, tables=["hub_meter", "sat_reading_metrics"])
    late = load_vault(
        readings.filter(f"not ({cut})"), None, early, tables=list(early), small_batch=True
    )
    for name, frame in early.items():
        assert rows(frame.unionByName(late[name]), "ldts") == rows(first[name], "ldts")
    pits = load_pits(spark, first, datetime(2024, 2, 1, 12, tzinfo=UTC))
    assert set(pits) == set(PITS)
    assert pits["pit_price"].count() == prices.count()


def test_a_stored_pit_moves_on_as_a_rebuild_would(spark, tmp_path):
    """Day by day: new keys, new versions, snapshots that come and go; equal to a rebuild each time."""
    table = StoredPit(str(tmp_path / "pit"), "hk", "s", "hk_d", "day")
    hubs = [("a", 1), ("b", 2), ("c", 4), ("d", 6)]
    versions = [("a", 1), ("a", 3), ("b", 2), ("b", 5), ("c", 4), ("a", 6), ("d", 6), ("d", 7)]
    moment = lambda day, hour=0: at(f"2026-01-{day:02d}T{hour:02d}:00:00")
    for today in (2, 3, 3, 5, 7, 9):
        keys = spark.createDataFrame([(k, "x") for k, day in hubs if day <= today], "hk string, extra string")
        sat = spark.createDataFrame([(k, moment(day), "p") for k, day in versions if day <= today], "hk string, ldts timestamp, payload string")
        kept = [d for d in range(1, today + 1) if d >= today - 2 or d == 1]
        calendar = spark.createDataFrame([(moment(d, 6), d in kept) for d in range(1, 12)], "sdts timestamp, is_active boolean")
        report = table.advance(keys, sat, calendar, "is_active")
        rebuilt = pit(keys, "hk", {"s": sat}, calendar, "is_active", "hk_d", "day")
        columns = ("hk_d", "hk", "sdts", "hk_s", "ldts_s")
        assert rows(table.read(spark), *columns) == rows(rebuilt, *columns), today
        assert not set(report.dropped) & {f"2026-01-{d:02d}" for d in kept}
    assert report.added == ("2026-01-08", "2026-01-09") and report.dropped == ("2026-01-05", "2026-01-06")
    assert table.advance(keys, sat, calendar, "is_active").rows_written == 0
