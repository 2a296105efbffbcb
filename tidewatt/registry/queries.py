"""One query per operator or model, over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.contracts import PRICE_FIELDS, READING_FIELDS, STATES
from tidewatt.functions.calendar import GRAIN_NAMES, GRAINS, date_key
from tidewatt.functions.geography import region_of
from tidewatt.functions.hashing import hash_diff
from tidewatt.operators.asof import LEVEL, asof_join, dyadic_blocks, effective_intervals, with_level
from tidewatt.operators.calendar import time_spine
from tidewatt.operators.checks import (
    accepted_range,
    accepted_values,
    not_empty,
    not_null,
    relationship,
    run_checks,
    unique,
)
from tidewatt.operators.distinct import bitmaps, dense_numbers, distinct_counts
from tidewatt.operators.keyed import first_by_key, latest_by_key
from tidewatt.operators.mapping import ColumnMapping
from tidewatt.operators.merge import ACTION, insert_only, upsert
from tidewatt.operators.snapshots import retained_snapshots, snapshot_calendar
from tidewatt.operators.validation import REASONS, RecordContract, ValidationRule, validate
from tidewatt.operators.vault import (
    HashDiff,
    hub,
    pit,
    read_as_of,
    satellite,
    stage,
)
from tidewatt.operators.windows import BackfillWindow
from tidewatt.plans import charts, curation, information, presentation, quality
from tidewatt.plans.activity import ActivityStore
from tidewatt.plans.incremental import IncrementalTotals, LoadReport
from tidewatt.plans.metrics import MetricLayer
from tidewatt.plans.stored_pit import StoredPit
from tidewatt.plans.vault_models import (
    MODELS,
    PITS,
    load_pit,
    load_vault,
    stage_prices,
    stage_readings,
)
from tidewatt.session import work_folder
from tidewatt.sinks.tables import stored
from tidewatt.sources import supplied
from tidewatt.sources.files import (
    RAW_PARTITION,
    folder_day,
    list_files,
    partition_inventory,
)
from tidewatt.sources.ledger import unseen_files
from tidewatt.sources.tables import source_meter_readings, table_source
from tidewatt.streaming import flows
from tidewatt.streaming.merged import HourlyMerge, LivePricing, run_batches

Query = Callable[[SparkSession, str], DataFrame]
LOAD_TS = datetime(2024, 2, 1, tzinfo=UTC)


def publish(frame: DataFrame) -> DataFrame:
    """Plain result types: zone-free timestamps, doubles, text for dates and lists."""

    def plain(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.ShortType):
            column = column.cast("int")
        elif isinstance(kind, T.ArrayType):
            column = F.concat_ws(",", column)
        return column.alias(field.name)

    return frame.select(*[plain(field) for field in frame.schema])


# Validation ---------------------------------------------------------------------------------

EVENT_CONTRACT = RecordContract(
    (
        ColumnMapping("event_id", "event_id", "string"),
        ColumnMapping("event_type", "kind", "string"),
        ColumnMapping("ts", "event_time", "timestamp"),
        ColumnMapping("value", "value", "double"),
        ColumnMapping("k_text", "k", "int"),
    ),
    ("event_id", "kind", "event_time", "value", "k"),
    (
        ValidationRule("domain:kind", lambda: F.col("kind").isin("click", "view", "purchase")),
        ValidationRule("range:value", lambda: F.col("value") >= 5),
        ValidationRule("range:k", lambda: F.col("k").between(10, 90)),
        ValidationRule(
            "domain:alignment",
            lambda: F.concat_ws(":", F.col("kind"), F.col("k") % 3).isin(
                "click:0", "click:1", "view:1", "view:2", "purchase:0", "purchase:2"
            ),
        ),
    ),
)


def _validated(spark: SparkSession, folder: str):
    # Large values arrive with a unit: the failed cast is NULL and reported as such.
    k = F.get_json_object("props", "$.k")
    events = supplied.table(spark, folder, "events").withColumn(
        "k_text", F.when(k >= "80", F.concat(k, F.lit(" kW"))).otherwise(k)
    )
    return validate(
        events,
        EVENT_CONTRACT,
        error_stage="events",
        error_timestamp=LOAD_TS,
        deduplicate_by=["event_id"],
        keep_first_by=["event_time"],
    )


def validate_valid(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder).valid


def validate_rejected_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder).rejected.select(
        "event_id", REASONS, "error_type", "error_stage"
    )


def validate_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    # A rejected row always has a reason. The outer form keeps Spark from adding a filter that
    # would evaluate every rule a second time.
    return (
        _validated(spark, folder)
        .rejected.select(F.explode_outer(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# Keys and merges ----------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = supplied.table(spark, folder, "lineitem")
    return first_by_key(lines, LINE_KEY, [F.col(name) for name in LINE_ORDER])


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = supplied.table(spark, folder, "orders")
    return latest_by_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    lines = supplied.table(spark, folder, "lineitem")
    order = [F.col(name) for name in LINE_ORDER]
    target = first_by_key(lines.filter("l_returnflag = 'N'"), LINE_KEY, order)
    return insert_only(target, lines.filter("l_returnflag <> 'N'"), LINE_KEY, LINE_ORDER)


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    lines = supplied.table(spark, folder, "lineitem")
    order = [F.col(name) for name in LINE_ORDER]
    target = first_by_key(lines.filter("l_linestatus = 'F'"), LINE_KEY, order)
    source = lines.filter("l_linestatus <> 'F'")
    merged = upsert(target, source, LINE_KEY, ["l_extendedprice", "l_shipdate"], LINE_ORDER)
    return merged.withColumnRenamed(ACTION, "merge_action")


# Windows and ledger -------------------------------------------------------------------------

WINDOW = BackfillWindow.parse("2024-01-10T00:00:00Z", "2024-01-24T00:00:00Z", "week")


def backfill_window_filter(spark: SparkSession, folder: str) -> DataFrame:
    return WINDOW.filter(supplied.readings(spark, folder), "event_time").select(
        "event_id", "event_time", "energy_kwh"
    )


def backfill_week_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per calendar batch; the batches partition the window."""
    readings = supplied.readings(spark, folder)
    parts = [
        batch.filter(readings, "event_time").select(
            F.lit(batch.start.isoformat()).alias("batch_start"),
            F.lit(batch.end.isoformat()).alias("batch_end"),
            "energy_kwh",
        )
        for batch in WINDOW.batches()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("batch_start", "batch_end").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("energy_kwh").alias("energy_kwh")
    )


def incremental_unseen(spark: SparkSession, folder: str) -> DataFrame:
    uri = F.concat(
        F.lit("lake/orders/"), F.date_format("o_orderdate", "yyyy/MM/dd/"), F.col("o_orderkey")
    )
    orders = supplied.table(spark, folder, "orders").withColumn("object_uri", uri)
    return unseen_files(orders, orders.filter("o_orderstatus = 'F'"))


# As-of pricing ------------------------------------------------------------------------------


def _intervals(spark: SparkSession, folder: str) -> DataFrame:
    return effective_intervals(
        supplied.prices(spark, folder), ["state_code"], "effective_from", "effective_to"
    )


def _priced(spark: SparkSession, folder: str, strategy: str = "bucket") -> DataFrame:
    return information.int_meter_readings_priced(
        supplied.readings(spark, folder), _intervals(spark, folder), strategy
    )


def query_effective_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return _intervals(spark, folder).select(
        "price_id", "state_code", "effective_from", "effective_to", "price_per_kwh"
    )


def _asof(strategy: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _priced(spark, folder, strategy).select(
            "event_id", "meter_id", "state_code", "event_time", "energy_kwh", "price_id",
            "price_effective_from", "price_per_kwh", "usage_revenue", "load_datetime",
        )

    return run


def asof_left(spark: SparkSession, folder: str) -> DataFrame:
    """As-of pricing per user, keeping readings without a price. Shows many small keys."""
    events = supplied.table(spark, folder, "events").withColumn("moment", F.col("ts").cast("timestamp"))
    tariffs = effective_intervals(
        events.filter("event_type = 'purchase'").select(
            "user_id", F.col("moment").alias("valid_from"), F.col("event_id").alias("price_id")
        ),
        ["user_id"], "valid_from", "valid_to",
    )
    readings = events.filter("event_type <> 'purchase'").select("event_id", "user_id", "moment")
    return asof_join(
        readings, tariffs, by=["user_id"], left_ts="moment", valid_from="valid_from",
        valid_to="valid_to", how="left", strategy="carry",
    )


def asof_after_last(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of 2024 against tariffs that all start in the 1990s: the last one stays in force."""
    orders = supplied.table(spark, folder, "orders").groupBy(
        (F.col("o_custkey") % 25).alias("zone"), F.col("o_orderdate").cast("timestamp").alias("valid_from")
    )
    tariffs = effective_intervals(
        orders.agg(F.min("o_orderkey").alias("tariff_id")), ["zone"], "valid_from", "valid_to", "month"
    )
    readings = supplied.table(spark, folder, "events").select(
        "event_id", (F.col("user_id") % 25).alias("zone"), F.col("ts").cast("timestamp").alias("moment")
    )
    return asof_join(
        readings, tariffs, by=["zone"], left_ts="moment", valid_from="valid_from",
        valid_to="valid_to", how="left", bucket="month",
    ).select("event_id", "zone", "tariff_id", "valid_to")


def _mixed_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Validity per customer or user: days to years between orders, minutes to days between
    purchases, and two decades from the last order to the first purchase."""
    orders = supplied.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("holder"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))).alias("valid_from"),
        F.col("o_orderkey").alias("tariff_id"),
    )
    bought = supplied.table(spark, folder, "events").filter("event_type = 'purchase'").select(
        F.col("user_id").alias("holder"), F.col("ts").cast("timestamp").alias("valid_from"), (-F.col("event_id")).alias("tariff_id")
    )
    starts = orders.unionByName(bought).groupBy("holder", "valid_from").agg(F.min("tariff_id").alias("tariff_id"))
    return effective_intervals(starts, ["holder"], "valid_from", "valid_to", "year")


def asof_dyadic(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments and events against intervals from minutes to decades, thousands of keys."""
    orders = supplied.table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("holder"))
    shipped = supplied.table(spark, folder, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), "holder",
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("l_partkey") % 1440).cast("int"))).alias("moment"),
    )
    seen = supplied.table(spark, folder, "events").filter("event_type <> 'purchase'").select(
        (-F.col("event_id") - 1).alias("row_id"), F.col("user_id").alias("holder"), F.col("ts").cast("timestamp").alias("moment")
    )
    return asof_join(
        shipped.unionByName(seen), _mixed_intervals(spark, folder), by=["holder"], left_ts="moment",
        valid_from="valid_from", valid_to="valid_to", how="left", strategy="dyadic",
    )


def asof_dyadic_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """What the intervals of ``asof_dyadic`` cost: blocks per level, beside one row per hour."""
    closed = _mixed_intervals(spark, folder).filter("valid_to is not null")
    blocks = dyadic_blocks(closed, "valid_from", "valid_to").groupBy(F.col(LEVEL).alias("level")).agg(
        F.count(F.lit(1)).alias("n_blocks")
    )
    whole_hours = (F.unix_micros(F.date_trunc("hour", "valid_to")) - F.unix_micros(F.date_trunc("hour", "valid_from"))) / 3_600_000_000
    hours = whole_hours.cast("bigint") + F.when(F.date_trunc("hour", "valid_to") == F.col("valid_to"), 0).otherwise(1)
    intervals = with_level(closed, "valid_from", "valid_to").groupBy(F.col(LEVEL).alias("level")).agg(
        F.count(F.lit(1)).alias("n_intervals"), F.sum(hours).alias("n_hours")
    )
    return intervals.join(blocks, "level")


def asof_unpriced(spark: SparkSession, folder: str) -> DataFrame:
    return information.readings_without_price(
        supplied.readings(spark, folder), _priced(spark, folder)
    )


# Vault --------------------------------------------------------------------------------------


def _vault(spark: SparkSession, folder: str, tables=tuple(MODELS)) -> dict[str, DataFrame]:
    build = {"readings": supplied.readings, "prices": supplied.prices}
    needed = {MODELS[name].source for name in tables}
    sources = {name: build[name](spark, folder) for name in needed}
    return load_vault(sources.get("readings"), sources.get("prices"), tables=tables)


def query_stage_readings(spark: SparkSession, folder: str) -> DataFrame:
    return stage_readings(supplied.readings(spark, folder)).select(
        "event_id", "hk_meter_h", "hk_reading_h", "hk_pricing_zone_h", "hk_meter_reading_l",
        "hk_meter_pricing_zone_l", "hd_meter_details_s", "hd_reading_metrics_s", "ldts", "rsrc",
    )


def query_stage_prices(spark: SparkSession, folder: str) -> DataFrame:
    return stage_prices(supplied.prices(spark, folder)).select(
        "price_id", "hk_pricing_zone_h", "hk_price_h", "hk_pricing_zone_price_l",
        "hd_price_details_s", "hd_pricing_zone_details_s", "ldts", "rsrc",
    )


def _vault_table(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _vault(spark, folder, [name])[name]

    return run


CUSTOMER_HASHES = {
    "hk_customer_h": ("customer_id",),
    "hd_customer_s": HashDiff(("order_status", "order_priority")),
}


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    rows = supplied.customer_states(spark, folder)
    return stage(rows, "load_datetime", "record_source", CUSTOMER_HASHES)


def _customer_satellite(staged: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return satellite(
        staged, "hk_customer_h", "hd_customer_s", ["order_status", "order_priority"], existing,
        tie_break=["o_orderkey"], slice_unit="year",
    )


def sat_history(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_satellite(_customers(spark, folder))


def sat_null_payload(spark: SparkSession, folder: str) -> DataFrame:
    """A satellite whose payload is wholly NULL in a third of the rows, within and across slices."""
    rows = supplied.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("hk_user"),
        F.col("ts").cast("timestamp").alias("ldts"),
        F.lit("events").alias("rsrc"),
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"),
    )
    rows = rows.withColumn("hd", hash_diff(["kind"]))
    return satellite(rows, "hk_user", "hd", ["kind"], tie_break=["event_id"], slice_unit="day").select(
        "hk_user", "ldts", "kind"
    )


def sat_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the second load appends: everything, when only orders before 1998 were loaded."""
    staged = _customers(spark, folder)
    loaded = _customer_satellite(staged.filter("ldts < timestamp'1998-01-01 00:00:00'"))
    return _customer_satellite(staged, loaded)


def hub_incremental(spark: SparkSession, folder: str) -> DataFrame:
    staged = _customers(spark, folder)
    early = staged.filter("ldts < timestamp'1995-03-01 00:00:00'")
    loaded = hub(early, "hk_customer_h", ["customer_id"])
    return hub(staged, "hk_customer_h", ["customer_id"], loaded)


def _as_of(spark: SparkSession, folder: str) -> Column:
    latest = supplied.table(spark, folder, "events").agg(F.max(F.col("ts").cast("timestamp")))
    return latest.scalar() + F.expr("interval 2 day")


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    as_of = _as_of(spark, folder)
    return retained_snapshots(snapshot_calendar(spark, as_of), as_of)


def query_snapshot_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_calendar(spark, _as_of(spark, folder))


def _pit_table(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        owner, key, sat, _, dimension = PITS[name]
        rows = load_pit(name, _vault(spark, folder, [owner, sat]), _snapshots(spark, folder))
        return rows.select(dimension, key, "sdts", f"hk_{sat}", f"ldts_{sat}")

    return run


def _customer_pit(spark: SparkSession, folder: str):
    """Customers at the start of each quarter of the order history."""
    staged = _customers(spark, folder)
    sat = _customer_satellite(staged)
    quarters = (
        staged.select(F.date_trunc("quarter", "ldts").alias("sdts"))
        .distinct()
        .withColumn("is_active", F.lit(True))
    )
    customers = hub(staged, "hk_customer_h", ["customer_id"])
    rows = pit(
        customers, "hk_customer_h", {"sat_customer": sat}, quarters, "is_active", "hk_customer_d"
    )
    return rows, sat


def pit_history(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_pit(spark, folder)[0]


def pit_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A stored point-in-time table moved on twice: quarters of two years are retained, customers
    and versions keep arriving, and the quarters that drop out lose their folders."""
    staged = stored(_customers(spark, folder), "customers")
    table = StoredPit(work_folder(spark, "pit"), "hk_customer_h", "sat_customer", "hk_customer_d", "year")
    for as_of in ("1997-02-01", "1997-08-01", "1999-05-01"):
        now = F.lit(as_of).cast("timestamp")
        known = staged.filter(F.col("ldts") < now)
        quarters = staged.select(F.date_trunc("quarter", "ldts").alias("sdts")).distinct().withColumn(
            "is_active", (F.col("sdts") <= now) & (F.col("sdts") >= now - F.expr("interval 24 month"))
        )
        table.advance(hub(known, "hk_customer_h", ["customer_id"]), _customer_satellite(known), quarters, "is_active")
    return table.read(spark)


def pit_asof_read(spark: SparkSession, folder: str) -> DataFrame:
    rows, sat = _customer_pit(spark, folder)
    return read_as_of(rows, sat, "sat_customer", "hk_customer_h").select(
        "hk_customer_h", "sdts", "order_status", "order_priority"
    )


# Information and presentation ---------------------------------------------------------------


READING_TABLES = (
    "hub_meter", "hub_reading", "link_meter_reading", "sat_meter_details", "sat_reading_metrics",
)
PRICE_TABLES = (
    "hub_pricing_zone", "hub_price", "link_pricing_zone_price", "sat_price_details",
    "sat_pricing_zone_details",
)


def int_readings(spark: SparkSession, folder: str) -> DataFrame:
    return information.int_meter_readings(_vault(spark, folder, READING_TABLES))


def int_prices(spark: SparkSession, folder: str) -> DataFrame:
    return information.int_electricity_prices(_vault(spark, folder, PRICE_TABLES))


def int_priced(spark: SparkSession, folder: str) -> DataFrame:
    vault = _vault(spark, folder, (*READING_TABLES, *PRICE_TABLES))
    return information.int_meter_readings_priced(
        information.int_meter_readings(vault),
        information.int_electricity_prices(vault),
    )


def _reading_fact(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.fact_meter_reading(supplied.readings(spark, folder))


def _meters(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.dim_meter(supplied.readings(spark, folder))


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.dim_pricing_zone(supplied.prices(spark, folder))


def _hourly_fact(spark: SparkSession, folder: str) -> DataFrame:
    return presentation.fact_hourly_energy_billing(_priced(spark, folder))


def dim_date_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings by the attributes of the date dimension."""
    counts = _reading_fact(spark, folder).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum("energy_kwh").alias("energy_kwh")
    )
    return presentation.with_dates(counts, presentation.dim_date(spark))


def dim_date_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by date attributes: none of them lies in the default calendar, so it is given the
    years 1996 to 1998; orders of other years stay, without attributes."""
    counts = supplied.table(spark, folder, "orders").groupBy(date_key(F.col("o_orderdate")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return presentation.with_dates(counts, presentation.dim_date(spark, "1996-01-01", "1999-01-01"))


def dim_time_readings(spark: SparkSession, folder: str) -> DataFrame:
    counts = _reading_fact(spark, folder).groupBy("time_key").agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum("energy_kwh").alias("energy_kwh")
    )
    return counts.join(presentation.dim_time(spark), "time_key")


def _spine(grain: str, column: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """All periods of the calendar, and those that hold readings outside it, with the readings
        of each."""
        period = F.date_trunc(grain, "event_time").alias("__period")
        counts = supplied.readings(spark, folder).groupBy(period).agg(
            F.count(F.lit(1)).alias("n_readings")
        )
        spine = time_spine(spark, grain).select(F.col(column).cast("timestamp").alias("period"))
        both = spine.join(counts, F.col("period") == F.col("__period"), "full_outer")
        return both.select(
            F.coalesce("period", "__period").alias("period"), F.coalesce("n_readings", F.lit(0)).alias("n_readings")
        )

    return run


def _operations(spark: SparkSession, folder: str, grains=GRAIN_NAMES) -> DataFrame:
    return presentation.mart_meter_operations(
        _reading_fact(spark, folder), _meters(spark, folder), grains
    )


def _billing(spark: SparkSession, folder: str, grains=GRAIN_NAMES) -> DataFrame:
    """The hourly fact is a stored table, as the mart reads it twice."""
    return presentation.mart_executive_billing(
        stored(_hourly_fact(spark, folder), "hourly-fact"),
        _meters(spark, folder),
        stored(_zones(spark, folder), "zones"),
        grains,
    )


def _shipped(spark: SparkSession, folder: str):
    """Fact, meters and zones of the shipments, and the fact's first hour. The zones are stored: Spark
    then knows their size and does not shuffle the fact to meet them."""
    rows = stored(supplied.billing_rows(spark, folder), "shipped")
    return (
        presentation.fact_hourly_energy_billing(rows),
        presentation.dim_meter(rows),
        stored(presentation.dim_pricing_zone(rows), "zones"),
        F.date_trunc("hour", rows.agg(F.min("event_time")).scalar()),
    )


def mart_billing_shipped(spark: SparkSession, folder: str, grains=GRAIN_NAMES) -> DataFrame:
    """The billing mart over seven years of shipments, in all five grains unless told otherwise."""
    fact, meters, zones, first = _shipped(spark, folder)
    return presentation.mart_executive_billing(fact, meters, zones, grains, first)


# Metrics and charts -------------------------------------------------------------------------


def _metric_layer(spark: SparkSession, folder: str) -> MetricLayer:
    return MetricLayer(
        {
            "int_meter_readings": lambda: supplied.readings(spark, folder),
            "fact_hourly_energy_billing": lambda: _hourly_fact(spark, folder),
            "dim_meter": lambda: _meters(spark, folder),
            "dim_pricing_zone": lambda: _zones(spark, folder),
            "meter_activity_hourly": lambda: _activity(spark, folder).read(spark),
        }
    )


def _saved(name: str) -> Query:
    return lambda spark, folder: _metric_layer(spark, folder).saved_query(name)


def _metrics(metrics, group_by=(), where=None) -> Query:
    return lambda spark, folder: _metric_layer(spark, folder).query(metrics, group_by, where)


def _chart(name: str, mart: Query, grain: str, start=None, end=None) -> Query:
    """A chart asks the mart for its own grain only."""
    return lambda spark, folder: charts.chart(name, mart(spark, folder, (grain,)), grain, start, end)


def _totals(names: tuple[str, ...], mart: Query, grain: str) -> Query:
    return lambda spark, folder: charts.totals(mart(spark, folder, (grain,)), names, grain)


def chart_grain_order(spark: SparkSession, folder: str) -> DataFrame:
    mart = _operations(spark, folder)
    counted = mart.groupBy("period_grain").agg(F.count(F.lit(1)).alias("n_periods"))
    return charts.grain_order(mart).join(counted, "period_grain")


# Distinct counts from stored bitmaps --------------------------------------------------------


def _activity(spark: SparkSession, folder: str, loads: int = 1) -> ActivityStore:
    """The readings' activity, stored in ``loads`` loads by arrival; the last load comes twice."""
    store = ActivityStore(
        work_folder(spark, "activity"), "meter_id", "event_time",
        (("us_region", "string"), ("state_code", "string")),
    )
    rows = supplied.readings(spark, folder)
    for load in [*range(loads), *([loads - 1] if loads > 1 else [])]:
        store.load(rows.where(F.col("event_id").cast("bigint") % loads == load) if loads > 1 else rows)
    return store


def distinct_meters_hour(spark: SparkSession, folder: str) -> DataFrame:
    return _activity(spark, folder).distinct(spark, "Hour", ["us_region", "state_code"], "n_meters")


def distinct_meters_grains(spark: SparkSession, folder: str) -> DataFrame:
    """All five grains by region, and the whole time, from one stored table of hours."""
    store = _activity(spark, folder)
    parts = [
        store.distinct(spark, grain, ["us_region"], "n_meters").withColumn("period_grain", F.lit(grain))
        for grain, _ in GRAINS
    ]
    whole = store.distinct(spark, None, ["us_region"], "n_meters")
    parts.append(whole.select(F.lit(None).cast("timestamp").alias("period_start"), "us_region", "n_meters", F.lit("All").alias("period_grain")))
    return reduce(DataFrame.unionByName, parts)


def distinct_meters_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads of interleaved readings, the last one repeated: weeks by state."""
    return _activity(spark, folder, 3).distinct(spark, "Week", ["state_code"], "n_meters")


def distinct_meters_range(spark: SparkSession, folder: str) -> DataFrame:
    """Days of ten days in January; the other days' folders are not read."""
    return _activity(spark, folder).distinct(
        spark, "Day", [], "n_meters", datetime(2024, 1, 5, 7, tzinfo=UTC), datetime(2024, 1, 15, 3, tzinfo=UTC)
    )


def distinct_shipped_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders shipped per year and flag: far more keys than one bucket of a bitmap holds."""
    lines = supplied.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_shipdate").cast("timestamp").alias("shipped_at"), "l_returnflag"
    )
    days = lines.select("order_id", F.date_trunc("month", "shipped_at").alias("month"), "l_returnflag").distinct()
    numbers = stored(dense_numbers(days, "order_id"), "order-numbers")
    months = stored(bitmaps(days.join(numbers, "order_id"), ["month", "l_returnflag"]), "order-months")
    return distinct_counts(months.withColumn("year", F.year("month")), ["year", "l_returnflag"], "n_orders")


# Checks -------------------------------------------------------------------------------------


def check_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Row-level checks of two tables, counted in one pass each."""
    tables = {
        "events": supplied.table(spark, folder, "events"),
        "lineitem": supplied.table(spark, folder, "lineitem"),
    }
    return run_checks(
        [
            not_null("events", "value"),
            not_empty("events", "event_type"),
            accepted_values("events", "event_type", ["click", "view", "purchase"]),
            accepted_range("events", "value", 5, 20),
            accepted_range("lineitem", "l_discount", 0, 0.05),
            accepted_range("lineitem", "l_tax", 0, 0.08, inclusive=False),
        ],
        tables,
    )


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    table = {"lineitem": supplied.table(spark, folder, "lineitem")}
    return unique("lineitem", "l_orderkey").violations(table)


def check_combo(spark: SparkSession, folder: str) -> DataFrame:
    table = {"lineitem": supplied.table(spark, folder, "lineitem")}
    return unique("lineitem", *LINE_KEY).violations(table)


def check_relationship(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "orders": supplied.table(spark, folder, "orders"),
        "lineitem": supplied.table(spark, folder, "lineitem"),
    }
    return relationship("orders", "o_orderkey", "lineitem", "l_orderkey").violations(tables)


def check_core(spark: SparkSession, folder: str) -> DataFrame:
    readings, prices = supplied.readings(spark, folder), supplied.prices(spark, folder)
    return run_checks(
        quality.core_checks(),
        {
            "smart_meter_events": readings,
            "electricity_prices": prices,
            "stg_meter_readings": stage_readings(readings),
            "stg_electricity_prices": stage_prices(prices),
        },
    )


def check_vault(spark: SparkSession, folder: str) -> DataFrame:
    """Over stored vault tables, as many checks read each."""
    vault = {name: stored(table, name) for name, table in _vault(spark, folder).items()}
    return run_checks(quality.vault_checks(), vault)


def check_information(spark: SparkSession, folder: str) -> DataFrame:
    prices = stored(_intervals(spark, folder), "prices")
    readings = supplied.readings(spark, folder)
    priced = information.int_meter_readings_priced(readings, prices)
    return run_checks(
        quality.information_checks(),
        {
            "int_electricity_prices": prices,
            "int_meter_readings": readings,
            "int_meter_readings_priced": stored(priced, "priced"),
        },
    )


def check_business_vault(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = stored(_snapshots(spark, folder), "snapshots")
    needed = [name for owner, _, sat, *_ in PITS.values() for name in (owner, sat)]
    vault = _vault(spark, folder, needed)
    pits = {name: stored(load_pit(name, vault, snapshots), name) for name in PITS}
    return run_checks(
        quality.business_vault_checks(),
        {
            "control_snap_v0": snapshot_calendar(spark, _as_of(spark, folder)),
            "control_snap_v1": snapshots,
            **pits,
        },
    )


def check_presentation(spark: SparkSession, folder: str) -> DataFrame:
    """Facts and marts are stored first: each is read by many checks."""
    meters, zones = _meters(spark, folder), _zones(spark, folder)
    readings = stored(_reading_fact(spark, folder), "reading-fact")
    hourly = stored(_hourly_fact(spark, folder), "hourly-fact")
    operations = presentation.mart_meter_operations(readings, meters)
    billing = presentation.mart_executive_billing(hourly, meters, zones)
    return run_checks(
        quality.presentation_checks(),
        {
            "dim_meter": meters,
            "dim_pricing_zone": zones,
            "dim_date": presentation.dim_date(spark),
            "dim_time": presentation.dim_time(spark),
            "fact_meter_reading": readings,
            "fact_hourly_energy_billing": hourly,
            "mart_meter_operations_periodic": stored(operations, "operations-mart"),
            "mart_executive_billing_periodic": stored(billing, "billing-mart"),
        },
    )


# Streams ------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = supplied.table(spark, folder, "events").schema
    return flows.parquet_stream(spark, folder, schema, "events.parquet").withColumn(
        "moment", F.col("ts").cast("timestamp")
    )


def _landed_amounts(spark: SparkSession, folder: str) -> DataFrame:
    stream = _event_stream(spark, folder).withColumn("amount", F.col("value").cast("decimal(12,5)"))
    return flows.run_available(stream.select("moment", "event_type", "amount"), "hourly")


def _hourly_amounts(landed: DataFrame) -> DataFrame:
    return flows.hour_table(landed, "moment", ["event_type"], {"amount": "amount"})


def stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per event type, late rows included; hours closed for an hour."""
    landed = _landed_amounts(spark, folder)
    return flows.closed_hours(_hourly_amounts(landed), landed, "moment")


def stream_hourly_all(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per event type of all rows, the last hours included."""
    return _hourly_amounts(_landed_amounts(spark, folder))


def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """The stream delivered twice; every event survives once."""
    once = _event_stream(spark, folder).select("event_id", "moment", "event_type", "value")
    twice = once.unionByName(
        _event_stream(spark, folder).select("event_id", "moment", "event_type", "value")
    )
    return flows.unique_rows(flows.run_available(twice, "dedupe"), ["event_id"], "moment")


def _landed_prices(spark: SparkSession, folder: str) -> DataFrame:
    tariffs = _intervals(spark, folder).select(
        "state_code", "us_region", F.col("effective_from").alias("price_effective_from"),
        "effective_to", "price_per_kwh",
    )
    readings = (
        _event_stream(spark, folder)
        .filter("event_type <> 'purchase'")
        .withColumns(
            {
                "zone_id": F.col("user_id") % 25,
                "event_time": F.col("moment"),
                "energy_kwh": F.col("value").cast("decimal(12,5)"),
            }
        )
    )
    readings = supplied.with_zone(readings, spark, folder).select(
        "user_id", "us_region", "state_code", "event_time", "energy_kwh"
    )
    enriched = flows.priced(readings, tariffs).withColumn(
        "usage_revenue", F.round(F.col("energy_kwh") * F.col("price_per_kwh"), 4)
    )
    needed = enriched.select("event_time", "user_id", "state_code", "energy_kwh", "usage_revenue")
    return flows.run_available(needed, "priced")


def _hourly_prices(landed: DataFrame) -> DataFrame:
    return flows.hour_table(
        landed, "event_time", ["user_id", "state_code"],
        {"energy_kwh": "energy_kwh", "usage_revenue": "usage_revenue"},
    )


def stream_priced(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as a stream, priced against the static intervals, summed per meter and hour, late
    rows included; hours closed for an hour."""
    landed = _landed_prices(spark, folder)
    return flows.closed_hours(_hourly_prices(landed), landed, "event_time")


def stream_priced_all(spark: SparkSession, folder: str) -> DataFrame:
    """The same of all readings, the last hours included."""
    return _hourly_prices(_landed_prices(spark, folder))


def _in_files(frame: DataFrame, folder: str, files: int) -> None:
    """``frame`` as ``files`` files that each hold rows of all times: arrival out of order."""
    for number in range(files):
        frame.where(F.pmod(F.xxhash64("event_id"), F.lit(files)) == number).coalesce(1).write.mode("append").parquet(folder)


def _file_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One file to a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_hourly_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per event type, merged batch by batch from files out of order."""
    base = work_folder(spark, "merged")
    events = supplied.table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("moment"), "event_type", F.col("value").cast("decimal(12,5)").alias("amount")
    )
    _in_files(events, f"{base}/in", 4)
    hourly = HourlyMerge(f"{base}/hours", "moment", (("event_type", "string"),), (("amount", "decimal(38,5)"),))
    run_batches(_file_stream(spark, f"{base}/in", events.schema), hourly.merge, f"{base}/checkpoint")
    return hourly.read(spark)


_LIVE_READINGS = (
    ("event_id", "string"), ("meter_id", "string"), ("us_region", "string"), ("state_code", "string"),
    ("event_time", "timestamp"), ("energy_kwh", "decimal(12,5)"),
)


def _live(spark: SparkSession, folder: str) -> LivePricing:
    """Two runs of one stream of readings; a third of the tariffs arrive between them."""
    base = work_folder(spark, "live")
    prices = supplied.prices(spark, folder).select("price_id", "state_code", "us_region", "effective_from", "price_per_kwh")
    readings = supplied.readings(spark, folder).select(*[name for name, _ in _LIVE_READINGS])
    late = F.col("price_id").cast("bigint") % 3 == 0

    def tariffs(session: SparkSession) -> DataFrame:
        known = session.read.schema(prices.schema).parquet(f"{base}/prices")
        intervals = effective_intervals(known, ["state_code"], "effective_from", "effective_to")
        return intervals.withColumnRenamed("effective_from", "price_effective_from")

    totals = IncrementalTotals(
        f"{base}/totals", "event_id", "event_time", (("meter_id", "string"), ("state_code", "string")),
        (("energy_kwh", "decimal(12,5)"), ("usage_revenue", "decimal(18,4)")), fixed_moment=True,
    )
    live = LivePricing(
        f"{base}/live", totals, _LIVE_READINGS, tariffs,
        lambda rows: rows.withColumn("usage_revenue", F.round(F.col("energy_kwh") * F.col("price_per_kwh"), 4)),
    )
    halves = [F.pmod(F.xxhash64("event_id"), F.lit(2)) == half for half in (0, 1)]
    for half, arriving in enumerate((~late, late)):
        prices.where(arriving).write.mode("append").parquet(f"{base}/prices")
        # As many files as the rows need; all that a run finds are one batch.
        readings.where(halves[half]).write.mode("append").parquet(f"{base}/in")
        run_batches(spark.readStream.schema(readings.schema).parquet(f"{base}/in"), live.process, f"{base}/checkpoint")
    return live


def stream_repriced(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per meter and state: late tariffs have re-priced the hours they touch."""
    hours = _live(spark, folder).totals.read_hours(spark)
    return hours.select(
        F.col("period_hour").alias("reading_hour"), "meter_id", "state_code", "energy_kwh", "usage_revenue",
        F.col("n_rows").alias("reading_count"),
    )


# Incremental totals -------------------------------------------------------------------------


def _billed(spark: SparkSession, folder: str) -> DataFrame:
    """Tariffs may change many times an hour: by the hour, every reading would meet all of its hour's."""
    return _priced(spark, folder, "dyadic").select("event_id", "meter_id", "state_code", "event_time", "energy_kwh", "usage_revenue")


def _two_loads(spark: SparkSession, folder: str) -> tuple[IncrementalTotals, list[LoadReport]]:
    """First nine tenths of the rows before 20 January; then the rest, late rows among them, and
    corrections of a seventh of the first: more energy, and 30 hours later for some."""
    totals = IncrementalTotals(
        work_folder(spark, "totals"), "event_id", "event_time", (("meter_id", "string"), ("state_code", "string")),
        (("energy_kwh", "decimal(12,5)"), ("usage_revenue", "decimal(18,4)")),
    )
    rows = stored(_billed(spark, folder), "billed")
    number, early = F.col("event_id").cast("bigint"), F.col("event_time") < F.lit("2024-01-20").cast("timestamp")
    corrected, moved = early & (number % 7 == 0), early & (number % 35 == 0)
    final = rows.select(
        "event_id", "meter_id", "state_code",
        F.when(moved, F.col("event_time") + F.expr("interval 30 hour")).otherwise(F.col("event_time")).alias("event_time"),
        (F.col("energy_kwh") + F.when(corrected, 1).otherwise(0)).cast("decimal(12,5)").alias("energy_kwh"),
        "usage_revenue",
        (~early | (number % 10 == 0) | corrected).alias("second"),
    )
    first = totals.load(rows.where(early & (number % 10 != 0)))
    second = totals.load(final.where("second"))
    return totals, [first, second]


def incremental_billing(spark: SparkSession, folder: str) -> DataFrame:
    """All five grains after both loads: equal to totals over the final rows."""
    return _two_loads(spark, folder)[0].read(spark)


def incremental_loads(spark: SparkSession, folder: str) -> DataFrame:
    """What each load touched and how many rows it summed again."""
    _, reports = _two_loads(spark, folder)
    found = [(n, r.touched_hours, r.rows_summed, r.touched_periods) for n, r in enumerate(reports, 1)]
    return spark.createDataFrame(found, "load int, touched_hours bigint, rows_summed bigint, touched_periods bigint")


# Jobs on raw files --------------------------------------------------------------------------


def _raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as source records; some break the contract, some are not JSON."""
    digest = F.md5(F.col("event_id").cast("string"))
    uuid = F.concat_ws(
        "-", digest.substr(1, 8), digest.substr(9, 4), F.concat(F.lit("4"), digest.substr(14, 3)),
        F.concat(F.lit("a"), digest.substr(18, 3)), digest.substr(21, 12),
    )
    k = F.get_json_object("props", "$.k").cast("int")
    state = F.element_at(
        F.array(*[F.lit(name) for name in STATES]),
        (F.col("user_id") % len(STATES) + 1).cast("int"),
    )
    record = F.struct(
        F.when(k == 1, "no-uuid").otherwise(uuid).alias("event_id"),
        F.when(k == 2, "2.0").otherwise("1.0").alias("schema_version"),
        F.concat(F.lit("meter-"), F.col("user_id")).alias("meter_id"),
        F.when(k == 3, "West").otherwise(region_of(state)).alias("us_region"),
        state.alias("state_code"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        F.when(k == 4, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("energy_kwh"),
        F.lit(230.0).alias("voltage_v"),
        F.when(k == 5, -1.0).otherwise(4.5).alias("current_a"),
        F.when(k > 95, 1.5).otherwise(0.95).alias("power_factor"),
    )
    text = F.to_json(record)
    return supplied.table(spark, folder, "events").select(
        F.when(k == 6, F.concat(F.lit("{oops "), text)).otherwise(text).alias("value"),
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
        F.date_format("ts", "HH").alias("hour"),
    )


def _curated(spark: SparkSession, folder: str) -> dict[str, str]:
    base = work_folder(spark, "lake")
    lake = {name: f"{base}/{name}" for name in ("raw", "curated", "errors", "ledger", "table")}
    (
        _raw_records(spark, folder)
        .drop("hour")
        .repartition("year", "month", "day")
        .write.partitionBy("year", "month", "day")
        .text(lake["raw"])
    )
    run = curation.JobRun(
        "run-1", LOAD_TS, ledger=curation.FileLedger(lake["ledger"], "raw-readings"), run_log=f"{base}/runs"
    )
    curation.raw_to_curated(
        spark, curation.RAW_READING_STREAM, run, lake["raw"], lake["curated"], lake["errors"]
    )
    return {**lake, "runs": f"{base}/runs"}


def job_backfill_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Two weeks of the raw zone curated by a backfill in week batches, run twice."""
    base = work_folder(spark, "backfill")
    (
        _raw_records(spark, folder)
        .drop("hour")
        .repartition("year", "month", "day")
        .write.partitionBy("year", "month", "day")
        .text(f"{base}/raw")
    )
    window = BackfillWindow.parse("2024-01-05T00:00:00Z", "2024-01-19T00:00:00Z", "week")
    for name in ("run-1", "run-2"):
        run = curation.JobRun(name, LOAD_TS, curation.ProcessingMode.BACKFILL, window)
        curation.raw_to_curated(
            spark, curation.RAW_READING_STREAM, run, f"{base}/raw", f"{base}/curated", f"{base}/errors"
        )
    curated = spark.read.parquet(f"{base}/curated")
    return curated.select(*[name for name, _, _ in READING_FIELDS])


def job_warehouse_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files to curated Parquet to the warehouse table, loaded twice: rows appear once."""
    lake = _curated(spark, folder)
    table = curation.readings_table(lake["table"])
    for name in ("load-1", "load-2"):
        curation.curated_to_warehouse(
            spark, curation.CURATED_READING_STREAM, curation.JobRun(name, LOAD_TS),
            lake["curated"], table, lake["errors"],
        )
    return table.read(spark).select(*[name for name, _, _ in READING_FIELDS])


def _raw_prices(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """Purchases as raw price records. The second batch corrects a third of the first: same state
    and start under a new id. Some records break the contract, some are not JSON."""
    name = F.concat(F.col("event_id").cast("string"), F.lit(f":{batch}"))
    digest = F.md5(name)
    uuid = F.concat_ws(
        "-", digest.substr(1, 8), digest.substr(9, 4), F.concat(F.lit("4"), digest.substr(14, 3)),
        F.concat(F.lit("a"), digest.substr(18, 3)), digest.substr(21, 12),
    )
    k = F.get_json_object("props", "$.k").cast("int")
    state = F.element_at(
        F.array(*[F.lit(name) for name in STATES]),
        (F.col("user_id") % len(STATES) + 1).cast("int"),
    )
    price = (F.col("value").cast("decimal(12,2)") + batch - 1).cast("string")
    record = F.struct(
        F.when(k == 1, "no-uuid").otherwise(uuid).alias("price_id"),
        F.when(k == 2, "2.0").otherwise("1.0").alias("schema_version"),
        F.when(k == 3, "West").otherwise(region_of(state)).alias("us_region"),
        state.alias("state_code"),
        F.lit("USD").alias("currency_code"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effective_from"),
        F.when(k == 4, "n/a").when(k == 5, "-1").otherwise(price).alias("price_per_kwh"),
        F.lit(f"feed-{batch}").alias("source_system"),
    )
    text = F.to_json(record)
    return (
        supplied.table(spark, folder, "events")
        .filter("event_type = 'purchase'")
        .filter(F.lit(True) if batch == 1 else F.col("event_id") % 3 == 0)
        .select(
            F.when(k == 6, F.concat(F.lit("{oops "), text)).otherwise(text).alias("value"),
            F.date_format("ts", "yyyy").alias("year"),
            F.date_format("ts", "MM").alias("month"),
            F.date_format("ts", "dd").alias("day"),
        )
    )


def _loaded_prices(spark: SparkSession, folder: str) -> tuple[dict[str, str], list[dict]]:
    """Two incremental runs, raw to curated to the warehouse table; the second run sees only the
    files of the second batch and updates prices in place."""
    base = work_folder(spark, "price-lake")
    lake = {name: f"{base}/{name}" for name in ("raw", "curated", "errors", "ledger", "table")}
    table, summaries = curation.prices_table(lake["table"]), []
    for batch in (1, 2):
        (
            _raw_prices(spark, folder, batch)
            .repartition("year", "month", "day")
            .write.partitionBy("year", "month", "day")
            .mode("append")
            .text(lake["raw"])
        )
        for stage, stream in (("raw", curation.RAW_PRICE_STREAM), ("curated", curation.CURATED_PRICE_STREAM)):
            run = curation.JobRun(f"run-{batch}", LOAD_TS, ledger=curation.FileLedger(lake["ledger"], stage))
            if stage == "raw":
                done = curation.raw_to_curated(spark, stream, run, lake["raw"], lake["curated"], lake["errors"])
            else:
                done = curation.curated_to_warehouse(spark, stream, run, lake["curated"], table, lake["errors"])
            summaries.append({"batch": batch, "stage": stage, **done})
    return lake, summaries


def job_warehouse_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The price table after both batches: corrected prices under the first id."""
    lake, _ = _loaded_prices(spark, folder)
    return curation.prices_table(lake["table"]).read(spark).select(*[name for name, _, _ in PRICE_FIELDS])


def job_price_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each of the four runs saw, rejected, inserted and updated."""
    _, summaries = _loaded_prices(spark, folder)
    names = ("rows", "malformed", "rejected", "inserted", "updated")
    seen = [(s["batch"], s["stage"], *[int(s[name]) for name in names]) for s in summaries]
    counts = spark.createDataFrame(seen, "batch int, stage string, " + ", ".join(f"n_{n} bigint" for n in names))
    return counts


def job_quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Quarantined records of the raw job by type and reason."""
    lake = _curated(spark, folder)
    schema = "error_reasons array<string>, error_stage string, error_type string"
    rejected = spark.read.schema(schema).json(lake["errors"])
    return (
        rejected.select("error_type", "error_stage", F.explode("error_reasons").alias("reason"))
        .groupBy("error_type", "error_stage", "reason")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def job_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The run log after an incremental run and one that finds no new file."""
    lake = _curated(spark, folder)
    again = curation.JobRun(
        "run-2", LOAD_TS, ledger=curation.FileLedger(lake["ledger"], "raw-readings"), run_log=lake["runs"]
    )
    curation.raw_to_curated(
        spark, curation.RAW_READING_STREAM, again, lake["raw"], lake["curated"], lake["errors"]
    )
    fields = "job string, run_id string, processing_mode string, processed_batches bigint, rows bigint, malformed bigint, rejected bigint"
    return spark.read.schema(fields).json(lake["runs"]).withColumnRenamed("rows", "n_rows")


def job_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files that each run has put into the ledger: every file once."""
    lake, _ = _loaded_prices(spark, folder)
    ledger = spark.read.parquet(lake["ledger"]).filter("stage = 'raw'")
    return ledger.groupBy("stage", "job_run_id", "completed_at").agg(
        F.count(F.lit(1)).alias("n_files"), F.count_distinct("object_uri").alias("n_distinct")
    )


def job_source_files(spark: SparkSession, folder: str) -> DataFrame:
    """Curated rows by the day folder of the file that each came from."""
    curated = spark.read.parquet(_curated(spark, folder)["curated"])
    return curated.groupBy(folder_day(F.col("record_source")).alias("source_day")).agg(
        F.count(F.lit(1)).alias("n_records"), F.max("raw_line_number").alias("max_line")
    )


def _raw_lines(spark: SparkSession, folder: str, purpose: str) -> str:
    base = work_folder(spark, purpose)
    _raw_records(spark, folder).select("value").write.text(f"{base}/in")
    return base


def _reading_lines(spark: SparkSession, base: str) -> DataFrame:
    names = [mapping.source for mapping in curation.RAW_READINGS.mappings]
    return flows.ndjson_stream(spark, f"{base}/in", names, flows.DEFAULT_BUFFER)


def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records landed by the hour of their own time, started twice: nothing lands twice."""
    base = _raw_lines(spark, folder, "landing")
    for _ in range(2):
        stream = _reading_lines(spark, base)
        flows.start_landing(stream, "event_time", f"{base}/landed", f"{base}/checkpoint").awaitTermination()
    landed = spark.read.json(f"{base}/landed")
    return landed.groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("meter_id").alias("n_meters")
    )


def stream_error_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Records that are not JSON, below their error type and processing hour."""
    base = _raw_lines(spark, folder, "error-landing")
    moment = F.lit("2024-02-01 13:00:00").cast("timestamp")
    for _ in range(2):
        stream = _reading_lines(spark, base)
        flows.start_error_landing(stream, f"{base}/errors", f"{base}/checkpoint", moment).awaitTermination()
    return spark.read.json(f"{base}/errors").groupBy("error_type", "year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if(F.col("record").startswith("{oops ")).alias("n_whole")
    )


def source_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The source-aligned table read back from its folder: its own columns and no others."""
    path = work_folder(spark, "source")
    supplied.readings(spark, folder).withColumn("internal_note", F.lit("x")).write.parquet(path)
    return source_meter_readings(table_source(spark, path))


def job_partition_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Hour folders of the raw zone."""
    base = work_folder(spark, "inventory")
    (
        _raw_records(spark, folder)
        .repartition("year", "month", "day")
        .write.partitionBy("year", "month", "day", "hour")
        .text(f"{base}/meter-readings")
    )
    return partition_inventory(list_files(spark, base), "meter-readings", RAW_PARTITION)


BILLING_TOTALS = ("Gross Billed", "Net Revenue", "Billed Energy", "Active Billed Meters")
OPERATION_TOTALS = (
    "Total Energy Consumed", "Total Meter Readings", "Reporting Meters", "Average Voltage",
    "Average Power Factor",
)

QUERIES: dict[str, Query] = {
    "validate_valid": validate_valid,
    "validate_rejected_reasons": validate_rejected_reasons,
    "validate_reason_counts": validate_reason_counts,
    "dedupe_first": dedupe_first,
    "latest_by_key": latest_per_key,
    "merge_insert_only": merge_insert_only,
    "merge_upsert": merge_upsert,
    "backfill_window_filter": backfill_window_filter,
    "backfill_week_batches": backfill_week_batches,
    "incremental_unseen": incremental_unseen,
    "effective_intervals": query_effective_intervals,
    "asof_priced": _asof("bucket"),
    "asof_priced_broadcast": _asof("bucket"),
    "asof_priced_shuffle": _asof("shuffle"),
    "asof_priced_carry": _asof("carry"),
    "asof_priced_dyadic": _asof("dyadic"),
    "asof_dyadic": asof_dyadic,
    "asof_dyadic_blocks": asof_dyadic_blocks,
    "asof_left": asof_left,
    "asof_after_last": asof_after_last,
    "asof_unpriced": asof_unpriced,
    "stage_readings": query_stage_readings,
    "stage_prices": query_stage_prices,
    **{name: _vault_table(name) for name in MODELS},
    "hub_incremental": hub_incremental,
    "sat_history": sat_history,
    "sat_null_payload": sat_null_payload,
    "sat_incremental": sat_incremental,
    "snapshot_calendar": query_snapshot_calendar,
    "snapshot_flags": _snapshots,
    **{name: _pit_table(name) for name in PITS},
    "pit_history": pit_history,
    "pit_asof_read": pit_asof_read,
    "pit_incremental": pit_incremental,
    "int_readings": int_readings,
    "int_prices": int_prices,
    "int_priced": int_priced,
    "dim_date": dim_date_readings,
    "dim_date_orders": dim_date_orders,
    "dim_time": dim_time_readings,
    "dim_meter": _meters,
    "dim_pricing_zone": _zones,
    "spine_hour": _spine("hour", "date_hour"),
    "spine_day": _spine("day", "date_day"),
    "spine_month": _spine("month", "date_month"),
    "spine_year": _spine("year", "date_year"),
    "fact_meter_reading": _reading_fact,
    "fact_hourly_billing": _hourly_fact,
    "mart_operations": _operations,
    "mart_billing": _billing,
    "mart_billing_shipped": mart_billing_shipped,
    "metric_daily_meter_kpis": _saved("daily_meter_kpis"),
    "metric_meter_electrical_kpis": _saved("meter_electrical_kpis"),
    "metric_daily_regional_billing": _saved("daily_regional_billing_kpis"),
    "metric_energy_per_meter": _metrics(
        ["energy_per_reporting_meter_kwh", "reporting_meters"], ["reading__region"]
    ),
    "metric_totals": _metrics(
        ["total_energy_consumed_kwh", "total_readings", "reporting_meters", "avg_voltage_v",
         "avg_current_a", "avg_power_factor", "billed_energy_kwh", "usage_revenue",
         "billed_meters", "realized_usage_price_per_kwh"]
    ),
    "metric_filtered_weeks": _metrics(
        ["total_energy_consumed_kwh", "billed_energy_kwh"],
        ["metric_time__week"],
        {"metric_time__day": lambda day: day >= F.lit("2024-01-05").cast("timestamp")},
    ),
    "metric_zone_revenue": _metrics(
        ["usage_revenue", "billed_meters"], ["pricing_zone__currency_code", "meter__region"]
    ),
    "metric_active_meters": _metrics(["active_meters"], ["activity__region", "metric_time__day"]),
    "distinct_meters_hour": distinct_meters_hour,
    "distinct_meters_grains": distinct_meters_grains,
    "distinct_meters_loads": distinct_meters_loads,
    "distinct_meters_range": distinct_meters_range,
    "distinct_shipped_orders": distinct_shipped_orders,
    "chart_totals_billing": _totals(BILLING_TOTALS, _billing, "Year"),
    "chart_billing_trend": _chart("Billing Trend", mart_billing_shipped, "Month"),
    "chart_billing_trend_hour": _chart("Billing Trend", mart_billing_shipped, "Hour"),
    "chart_revenue_region": _chart("Revenue by US Region", mart_billing_shipped, "Year"),
    "chart_revenue_state": _chart("Revenue by State", mart_billing_shipped, "Year"),
    "chart_realized_price": _chart("Realized Price per kWh", mart_billing_shipped, "Week"),
    "chart_totals_operations": _totals(OPERATION_TOTALS, _operations, "Year"),
    "chart_energy_trend": _chart("Energy Consumption Trend", _operations, "Day"),
    "chart_energy_trend_range": _chart(
        "Energy Consumption Trend", _operations, "Hour",
        datetime(2024, 1, 10, tzinfo=UTC), datetime(2024, 1, 12, tzinfo=UTC),
    ),
    "chart_top_meters": _chart("Top Meters by Energy", _operations, "Year"),
    "chart_health_trend": _chart("Electrical Health Trend", _operations, "Day"),
    "chart_grain_order": chart_grain_order,
    "check_rows": check_rows,
    "check_unique": check_unique,
    "check_combo": check_combo,
    "check_relationship": check_relationship,
    "check_core": check_core,
    "check_vault": check_vault,
    "check_business_vault": check_business_vault,
    "check_information": check_information,
    "check_presentation": check_presentation,
    "stream_hourly": stream_hourly,
    "stream_hourly_all": stream_hourly_all,
    "stream_dedupe": stream_dedupe,
    "stream_priced": stream_priced,
    "stream_priced_all": stream_priced_all,
    "stream_hourly_merged": stream_hourly_merged,
    "stream_repriced": stream_repriced,
    "incremental_billing": incremental_billing,
    "incremental_loads": incremental_loads,
    "job_backfill_readings": job_backfill_readings,
    "job_warehouse_readings": job_warehouse_readings,
    "job_warehouse_prices": job_warehouse_prices,
    "job_price_counts": job_price_counts,
    "job_quarantine_reasons": job_quarantine_reasons,
    "job_partition_inventory": job_partition_inventory,
    "job_summaries": job_summaries,
    "job_ledger": job_ledger,
    "job_source_files": job_source_files,
    "stream_landing": stream_landing,
    "stream_error_landing": stream_error_landing,
    "source_readings": source_readings,
}


def published() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, folder: publish(query(spark, folder))

    return {name: wrap(query) for name, query in QUERIES.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly billing: validated readings, as-of priced, summed per meter and hour."""
    return publish(_hourly_fact(spark, folder))
