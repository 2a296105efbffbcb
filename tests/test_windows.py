import pytest
from frames import rows
from hypothesis import given
from hypothesis import strategies as st

from tidewatt.operators.windows import BackfillWindow, ProcessingMode


def window(start, end, grain):
    return BackfillWindow.parse(f"{start}T00:00:00Z", f"{end}T00:00:00+00:00", grain)


def spans(found):
    return [(b.start.isoformat(), b.end.isoformat()) for b in found.batches()]


def test_month_batches_and_roots():
    found = window("2026-01-15", "2026-03-02", "month")
    assert spans(found) == [
        ("2026-01-15", "2026-02-01"), ("2026-02-01", "2026-03-01"), ("2026-03-01", "2026-03-02")
    ]
    assert found.source_paths("s3://b/raw/") == [
        "s3://b/raw/year=2026/month=01/",
        "s3://b/raw/year=2026/month=02/",
        "s3://b/raw/year=2026/month=03/",
    ]


def test_week_batches_start_on_monday():
    found = window("2026-01-15", "2026-01-27", "week")
    assert spans(found) == [
        ("2026-01-15", "2026-01-19"), ("2026-01-19", "2026-01-26"), ("2026-01-26", "2026-01-27")
    ]
    paths = found.batches()[1].source_paths("base")
    assert len(paths) == 7
    assert paths[0] == "base/year=2026/month=01/day=19/"


def test_day_batches():
    assert len(window("2026-02-27", "2026-03-02", "day").batches()) == 3


@given(st.dates(), st.integers(1, 800), st.sampled_from(["day", "week", "month"]))
def test_batches_partition_the_window(start, length, grain):
    from datetime import date, timedelta

    if start > date(9990, 1, 1):
        return
    found = BackfillWindow(start, start + timedelta(days=length), grain).batches()
    assert found[0].start == start
    assert found[-1].end == start + timedelta(days=length)
    assert all(a.end == b.start for a, b in zip(found, found[1:], strict=False))
    assert all(b.start < b.end for b in found)


@pytest.mark.parametrize(
    ("start", "end", "grain", "message"),
    [
        ("2026-01-15T00:00:00Z", "2026-01-15T00:00:00Z", "day", "must lie after"),
        ("2026-01-15T06:00:00Z", "2026-01-16T00:00:00Z", "day", "not midnight in UTC"),
        ("2026-01-15T00:00:00", "2026-01-16T00:00:00Z", "day", "has no zone"),
        ("soon", "2026-01-16T00:00:00Z", "day", "ISO format"),
        ("2026-01-15T00:00:00Z", "2026-01-16T00:00:00Z", "hour", "no backfill grain"),
    ],
)
def test_window_errors(start, end, grain, message):
    with pytest.raises(ValueError, match=message):
        BackfillWindow.parse(start, end, grain)


def test_modes():
    assert ProcessingMode.parse("incremental") is ProcessingMode.INCREMENTAL
    assert ProcessingMode.parse("backfill", ledger_disabled=True) is ProcessingMode.BACKFILL
    with pytest.raises(ValueError, match="without a ledger"):
        ProcessingMode.parse("backfill")
    with pytest.raises(ValueError, match="no processing mode"):
        ProcessingMode.parse("repartition-everything")


def test_scan_adds_one_day_on_each_side():
    month = BackfillWindow.parse("2026-01-01T00:00:00Z", "2026-02-01T00:00:00Z", "month")
    assert month.source_paths("raw") == ["raw/year=2026/month=01/"]
    assert month.scan_paths("raw") == ["raw/year=2026/month=01/", "raw/year=2025/month=12/day=31/", "raw/year=2026/month=02/day=01/"]
    part = BackfillWindow.parse("2026-01-10T00:00:00Z", "2026-01-20T00:00:00Z", "month")
    assert part.scan_paths("raw") == ["raw/year=2026/month=01/"]
    week = BackfillWindow.parse("2026-01-05T00:00:00Z", "2026-01-12T00:00:00Z", "week")
    assert len(week.scan_paths("raw")) == 9 and len(set(week.scan_paths("raw"))) == 9


def test_half_open_filter(spark):
    frame = spark.createDataFrame(
        [("2026-01-14 23:59:59",), ("2026-01-15 00:00:00",), ("2026-01-16 00:00:00",), (None,)],
        "t string",
    )
    kept = window("2026-01-15", "2026-01-16", "day").filter(frame, "t")
    assert rows(kept) == [("2026-01-15 00:00:00",)]
