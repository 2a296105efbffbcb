"""Helpers of the tests; a module of its own, as every folder may have a conftest."""

from datetime import UTC, datetime


def at(text: str) -> datetime:
    """UTC instant; Spark returns naive values in the session's zone."""
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def rows(frame, *columns):
    """Rows as sorted tuples of text, so that order and types do not matter."""
    picked = frame.select(*columns) if columns else frame
    found = [tuple(None if v is None else str(v) for v in row) for row in picked.collect()]
    return sorted(found, key=lambda row: [(v is not None, v or "") for v in row])


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
