"""Registered queries against an independent SQL engine, and properties of their plans."""

import importlib.util
import os
import re
from pathlib import Path

import pytest
from frames import plan

from tidewatt.registry.oracles import oracle_statements
from tidewatt.registry.queries import published

ROOT = Path(__file__).resolve().parents[1]
TABLES = "region nation customer supplier part orders lineitem events".split()
# A cross-section; TIDEWATT_ALL=1 compares every query.
SAMPLE = [
    "validate_rejected_reasons", "dedupe_first", "merge_upsert", "backfill_week_batches",
    "asof_priced", "asof_left", "asof_after_last", "stage_readings", "sat_meter_details", "sat_incremental", "sat_null_payload",
    "snapshot_flags", "pit_history", "int_prices", "fact_hourly_billing", "mart_operations",
    "mart_billing_shipped", "metric_totals", "metric_daily_regional_billing", "chart_top_meters", "chart_billing_trend_hour",
    "check_core", "stream_hourly", "job_backfill_readings",
]


def load_entry():
    spec = importlib.util.spec_from_file_location("entry_points", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = load_entry()
QUERIES, STATEMENTS = published(), oracle_statements()
NAMES = sorted(QUERIES) if os.environ.get("TIDEWATT_ALL") else SAMPLE


@pytest.fixture(scope="module")
def engine(small):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(STATEMENTS)
    assert len(QUERIES) >= 80
    assert set(QUERIES) <= set(ENTRY.queries()) and set(STATEMENTS) <= set(ENTRY.oracle_sql())


def test_entry(spark):
    frame = ENTRY.entry(spark)
    assert frame.count() == 710
    assert "usage_revenue" in frame.columns


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, engine, small, name):
    frame = QUERIES[name](spark, small)
    columns = sorted(frame.columns)
    result = engine.execute(STATEMENTS[name])
    order = [column[0] for column in result.description]
    assert sorted(order) == columns
    text = lambda values: tuple("~" if value is None else str(value) for value in values)
    found = sorted(text(row[c] for c in columns) for row in frame.collect())
    places = [order.index(c) for c in columns]
    expected = sorted(text(row[i] for i in places) for row in result.fetchall())
    assert found == expected


@pytest.mark.parametrize(
    "name", ["int_priced", "asof_priced_carry", "sat_history", "pit_reading", "mart_billing"]
)
def test_plans_stay_in_the_engine(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_unforced_join_is_on_the_bucket(spark, small):
    text = plan(QUERIES["asof_priced_shuffle"](spark, small))
    assert re.search(r"SortMergeJoin \[[^]]*__bucket", text)


def test_first_row_per_key_is_limited_before_the_shuffle(spark, small):
    text = plan(QUERIES["dedupe_first"](spark, small))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_scan_is_pruned_and_filtered(spark, small):
    text = plan(QUERIES["chart_energy_trend"](spark, small))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,purchase))" in text
    assert "o_totalprice" not in plan(QUERIES["mart_billing_shipped"](spark, small))
