"""Processing modes, backfill windows and their calendar batches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta
from enum import StrEnum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.functions.calendar import instant


class ProcessingMode(StrEnum):
    INCREMENTAL = "incremental"
    BACKFILL = "backfill"

    @classmethod
    def parse(cls, text: str, ledger_disabled: bool = False) -> ProcessingMode:
        """Backfill must see every source file, so it refuses to run with a ledger."""
        if text not in {mode.value for mode in cls}:
            choices = ", ".join(mode.value for mode in cls)
            raise ValueError(f"no processing mode {text!r}; known: {choices}")
        mode = cls(text)
        if mode is cls.BACKFILL and not ledger_disabled:
            raise ValueError("a backfill reads every file of its window: run it without a ledger")
        return mode


class BackfillGrain(StrEnum):
    DAY = "day"
    WEEK = "week"
    MONTH = "month"


def _next_edge(day: date, grain: BackfillGrain) -> date:
    if grain is BackfillGrain.DAY:
        return day + timedelta(days=1)
    if grain is BackfillGrain.WEEK:
        return day + timedelta(days=7 - day.weekday())
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1)


def _utc_midnight(text: str, name: str) -> date:
    try:
        moment = datetime.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"{name}: not a timestamp in ISO format") from error
    if moment.tzinfo is None:
        raise ValueError(f"{name}: the timestamp has no zone")
    moment = moment.astimezone(UTC)
    if moment.time() != time():
        raise ValueError(f"{name}: not midnight in UTC")
    return moment.date()


@dataclass(frozen=True)
class BackfillWindow:
    """Days from ``start`` up to, not including, ``end``."""

    start: date
    end: date
    grain: BackfillGrain

    @classmethod
    def parse(cls, start: str, end: str, grain: str) -> BackfillWindow:
        first, last = _utc_midnight(start, "backfill_start"), _utc_midnight(end, "backfill_end")
        if first >= last:
            raise ValueError("backfill_end must lie after backfill_start")
        if grain not in {item.value for item in BackfillGrain}:
            choices = ", ".join(item.value for item in BackfillGrain)
            raise ValueError(f"no backfill grain {grain!r}; known: {choices}")
        return cls(first, last, BackfillGrain(grain))

    def batches(self) -> tuple[BackfillWindow, ...]:
        """Calendar batches, clipped to the window."""
        edges = [self.start]
        while edges[-1] < self.end:
            edges.append(min(_next_edge(edges[-1], self.grain), self.end))
        return tuple(
            BackfillWindow(first, last, self.grain)
            for first, last in zip(edges, edges[1:], strict=False)
        )

    def days(self) -> list[date]:
        return [self.start + timedelta(days=n) for n in range((self.end - self.start).days)]

    def source_paths(self, base: str) -> list[str]:
        """Partition roots to read: month folders for month grain, day folders otherwise."""
        layout = "year=%Y/month=%m/"
        if self.grain is not BackfillGrain.MONTH:
            layout += "day=%d/"
        roots = dict.fromkeys(day.strftime(layout) for day in self.days())
        return [f"{base.rstrip('/')}/{root}" for root in roots]

    def scan_paths(self, base: str) -> list[str]:
        """The partition roots and one day folder on each side of the window.

        Raw folders follow the characters of the timestamp, so a zone offset can move a record
        by a day. The exact filter comes after the scan.
        """
        roots = self.source_paths(base)
        layout = f"{base.rstrip('/')}/year=%Y/month=%m/day=%d/"
        sides = [day.strftime(layout) for day in (self.start - timedelta(days=1), self.end)]
        return roots + [side for side in sides if not side.startswith(tuple(roots))]

    def filter(self, frame: DataFrame, timestamp_column: str) -> DataFrame:
        """Exact half-open boundaries."""
        moment = F.col(timestamp_column).cast("timestamp")
        first = instant(datetime.combine(self.start, time(), UTC))
        last = instant(datetime.combine(self.end, time(), UTC))
        return frame.filter((moment >= first) & (moment < last))

    def partition_filter(self, frame: DataFrame) -> DataFrame:
        """Same window on the curated zone's year/month/day columns, so folders are pruned."""
        day = F.concat_ws("-", "year", "month", "day")
        return frame.filter(
            (day >= F.lit(self.start.isoformat())) & (day < F.lit(self.end.isoformat()))
        )
