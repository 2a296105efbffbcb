import re
from datetime import UTC, datetime

import pytest
from frames import at, plan, rows
from pyspark.sql import functions as F

from tidewatt.functions.arithmetic import rounded_ratio
from tidewatt.functions.calendar import GRAIN_NAMES, day_part
from tidewatt.operators.calendar import time_spine
from tidewatt.plans import charts, information, presentation
from tidewatt.plans.metrics import (
    BILLING_METER,
    HOURLY_BILLING,
    METER_READINGS,
    MetricLayer,
)
from tidewatt.plans.vault_models import load_vault
from tidewatt.sources import supplied


def readings(spark, values):
    frame = spark.createDataFrame(
        [(f"e{n}", m, s, at(t), kwh) for n, (m, s, t, kwh) in enumerate(values)],
        "event_id string, meter_id string, state_code string, event_time timestamp, kwh double",
    )
    return frame.select(
        "event_id", "meter_id", F.lit("South").alias("us_region"), "state_code", "event_time",
        F.col("kwh").cast("decimal(12,5)").alias("energy_kwh"),
        F.lit(230).cast("decimal(8,2)").alias("voltage_v"),
        F.lit(4).cast("decimal(8,3)").alias("current_a"),
        F.lit("0.9").cast("decimal(5,3)").alias("power_factor"),
        F.lit("1.0").alias("schema_version"),
        F.col("event_time").alias("load_datetime"),
        F.lit("USD").alias("currency_code"),
        (F.col("kwh") * 2).cast("decimal(19,4)").alias("usage_revenue"),
    )


def test_spines(spark):
    sizes = {g: time_spine(spark, g).count() for g in ("hour", "day", "month", "year")}
    assert sizes == {"hour": 140_256, "day": 5_844, "month": 192, "year": 16}
    with pytest.raises(ValueError, match="grain must be"):
        time_spine(spark, "minute")


def test_dimensions(spark):
    days = presentation.dim_date(spark)
    row = days.filter("date_key = 20260802").first()
    assert (row.month_name, row.iso_day_of_week, row.is_weekend) == ("August", 7, True)
    assert (row.calendar_year, row.calendar_quarter, row.calendar_month) == (2026, 3, 8)
    hours = presentation.dim_time(spark)
    assert hours.count() == 24
    assert hours.filter("time_key = 7").first().hour_start == "07:00:00"
    parts = spark.createDataFrame([(h,) for h in (5, 6, 11, 12, 17, 18)], "h int")
    found = [r[0] for r in parts.orderBy("h").select(day_part(F.col("h"))).collect()]
    assert found == ["Overnight", "Morning", "Morning", "Afternoon", "Afternoon", "Evening"]


def test_first_periods_start_with_the_data(spark):
    frame = readings(
        spark,
        [("m", "TX", "2026-01-15T10:20:00", 1.0), ("m", "TX", "2026-01-15T10:40:00", 2.0),
         ("m", "TX", "2026-02-03T00:10:00", 4.0)],
    )
    mart = presentation.mart_meter_operations(
        presentation.fact_meter_reading(frame), presentation.dim_meter(frame)
    )
    found = rows(mart, "period_grain", "period_start", "energy_kwh", "reading_count")
    start = "2026-01-15 10:20:00"
    assert found == [
        ("Day", start, "3.00000", "2"),
        ("Day", "2026-02-03 00:00:00", "4.00000", "1"),
        ("Hour", start, "3.00000", "2"),
        ("Hour", "2026-02-03 00:00:00", "4.00000", "1"),
        ("Month", start, "3.00000", "2"),
        ("Month", "2026-02-01 00:00:00", "4.00000", "1"),
        ("Week", start, "3.00000", "2"),
        ("Week", "2026-02-02 00:00:00", "4.00000", "1"),
        ("Year", start, "7.00000", "3"),
    ]


def test_hourly_fact_and_zero_energy(spark):
    priced = readings(
        spark, [("m", "TX", "2026-01-15T10:20:00", 0.0), ("n", "TX", "2026-01-15T10:20:00", 3.0)]
    )
    found = {r.energy_kwh: r.price_per_kwh for r in
             presentation.fact_hourly_energy_billing(priced).collect()}
    assert {str(k): str(v) for k, v in found.items()} == {"0.00000": "None", "3.00000": "2.000000"}


def test_ratio_is_rounded_once(spark):
    frame = spark.createDataFrame([("0.1126", "23.96"), ("-1", "3"), ("1", "0")], "a string, b string")
    ratio = rounded_ratio(F.col("a").cast("decimal(29,4)"), F.col("b").cast("decimal(22,5)"), 6)
    assert [str(r[0]) for r in frame.select(ratio).collect()] == ["0.004699", "-0.333333", "None"]


def test_billing_mart_sums_agree_across_grains(spark, small):
    rows_ = supplied.billing_rows(spark, small)
    mart = presentation.mart_executive_billing(
        presentation.fact_hourly_energy_billing(rows_),
        presentation.dim_meter(rows_),
        presentation.dim_pricing_zone(rows_),
    ).cache()
    sums = {r[0]: (r[1], r[2]) for r in mart.groupBy("period_grain").agg(
        F.sum("net_revenue"), F.sum("energy_kwh")).collect()}
    assert set(sums) == set(GRAIN_NAMES)
    total = rows_.agg(F.sum("usage_revenue"), F.sum("energy_kwh")).first()
    assert all(found == (total[0], total[1]) for found in sums.values())
    sample = mart.filter("net_revenue > 0").first()
    assert abs(float(sample.gross_billed) - float(sample.net_revenue) * 1.05) < 1e-4
    first = mart.agg(F.min("period_start")).first()[0]
    assert first == rows_.agg(F.min("event_time")).first()[0]
    mart.unpersist()


def test_vault_path_equals_direct_path(spark, small):
    readings_, prices = supplied.readings(spark, small), supplied.prices(spark, small)
    vault = load_vault(readings_, prices)
    current = information.int_meter_readings(vault)
    names = ["event_id", "meter_id", "state_code", "event_time", "energy_kwh"]
    assert rows(current, *names) == rows(readings_, *names)
    intervals = information.int_electricity_prices(vault)
    assert intervals.filter("effective_to is null").count() == 15


def test_charts(spark):
    values = [(f"m{n:02d}", "TX", "2026-01-15T10:20:00", 10.0 if n < 9 else 5.0) for n in range(12)]
    frame = readings(spark, values)
    mart = presentation.mart_meter_operations(
        presentation.fact_meter_reading(frame), presentation.dim_meter(frame)
    )
    top = charts.chart("Top Meters by Energy", mart).collect()
    assert [r.meter_id for r in top] == [f"m{n:02d}" for n in range(10)]
    totals = charts.totals(mart, ("Total Energy Consumed", "Reporting Meters", "Average Voltage"))
    assert [str(v) for v in totals.first()] == ["105.00000", "12", "230.0"]
    assert [r[0] for r in charts.grain_order(mart).collect()] == list(GRAIN_NAMES)
    exact = datetime(2026, 1, 15, 10, 20, tzinfo=UTC)
    assert charts.chart("Energy Consumption Trend", mart, "Hour", exact, exact).count() == 1
    later = datetime(2026, 1, 16, tzinfo=UTC)
    assert charts.chart("Energy Consumption Trend", mart, "Hour", later).count() == 0
    with pytest.raises(ValueError, match="grain must be"):
        charts.chart("Total Energy Consumed", mart, "Decade")
    assert len(charts.CHARTS) == 16
    labelled = mart.agg(charts.sql_metric("x", "sum(energy_kwh)"), charts.metric("y", "MAX", "meter_id"))
    assert labelled.columns == ["x", "y"]


def layer(spark):
    frame = readings(
        spark,
        [("a", "TX", "2026-01-15T10:20:00", 1.0), ("a", "TX", "2026-01-16T10:20:00", 2.0),
         ("b", "TX", "2026-01-16T11:20:00", 4.0)],
    )
    fact = presentation.fact_hourly_energy_billing(frame.filter("meter_id = 'a'"))
    return MetricLayer(
        {
            "int_meter_readings": frame,
            "fact_hourly_energy_billing": fact,
            "dim_meter": lambda: presentation.dim_meter(frame),
            "dim_pricing_zone": lambda: presentation.dim_pricing_zone(frame),
        }
    )


def test_metrics(spark):
    metrics = layer(spark)
    one = metrics.query(["energy_per_reporting_meter_kwh", "total_readings"]).first()
    assert one[0] == 3.5 and one[1] == 3
    both = metrics.query(["total_energy_consumed_kwh", "usage_revenue"], ["metric_time__day"])
    assert rows(both) == [
        ("2026-01-15 00:00:00", "1.00000", "2.0000"), ("2026-01-16 00:00:00", "6.00000", "4.0000")
    ]
    per_meter = metrics.saved_query("meter_electrical_kpis")
    assert per_meter.count() == 3
    regional = metrics.saved_query("daily_regional_billing_kpis").orderBy("metric_time__day").first()
    assert regional["meter__region"] == "South" and regional["realized_usage_price_per_kwh"] == 2.0
    filtered = metrics.query(["total_readings"], where={"meter": lambda c: c == "b"}).first()
    assert filtered[0] == 1
    totals = metrics.query(["total_readings", "billed_meters"]).first()
    assert tuple(totals) == (3, 1)


def test_entities_with_other_expressions_are_refused(spark):
    metrics = layer(spark)
    with pytest.raises(ValueError, match="another expression"):
        metrics.query(["total_readings"], ["meter__meter_id"])
    with pytest.raises(ValueError, match="no entity"):
        metrics.query(["total_readings"], ["pricing_zone__currency_code"])
    with pytest.raises(ValueError, match="time grain"):
        metrics.query(["total_readings"], ["metric_time__minute"])
    assert METER_READINGS.entity("meter").expr != BILLING_METER.entity("meter").expr
    assert HOURLY_BILLING.entity("meter").expr == BILLING_METER.entity("meter").expr


def test_the_fact_is_dealt_once_for_all_grains(spark):
    """By meter: no total is shuffled again, nor to meet its meter, nor is the fact to meet its zone."""
    frame = readings(spark, [("a", "TX", "2026-01-01 00:30:00", 1.0), ("b", "TX", "2026-02-01 00:30:00", 2.0)])
    fact, meters, zones = (
        presentation.fact_hourly_energy_billing(frame), presentation.dim_meter(frame), presentation.dim_pricing_zone(frame)
    )
    first = F.lit(at("2026-01-01 00:00:00"))
    text = plan(presentation.mart_executive_billing(fact, meters, zones, data_start=first))
    shuffles = re.findall(r"Exchange hashpartitioning\((.*)", text)
    assert not [line for line in shuffles if "__at" in line or "__period" in line]
    assert "SortMergeJoin [meter_key" not in text
    given = presentation.mart_executive_billing(fact, meters, zones, data_start=first).collect()
    assert sorted(map(str, given)) == sorted(map(str, presentation.mart_executive_billing(fact, meters, zones).collect()))
    assert len(given) == 10
