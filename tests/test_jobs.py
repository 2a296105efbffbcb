import json
import shutil
from datetime import UTC, datetime
from pathlib import Path

import pytest
from frames import at, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.operators.checks import not_null, unique
from tidewatt.operators.merge import ACTION, insert_only, rows_to_insert, upsert
from tidewatt.operators.windows import BackfillWindow, ProcessingMode
from tidewatt.plans import curation
from tidewatt.plans.quality import warehouse_constraints
from tidewatt.session import work_folder
from tidewatt.sinks.jdbc import JdbcStaging
from tidewatt.sinks.partitioned import write_partitioned, write_rejected
from tidewatt.sinks.run_log import emit_summary
from tidewatt.sinks.tables import (
    ConstraintViolation,
    SnapshotTable,
    UnfinishedMerge,
    enforce,
    materialize,
    stored,
)
from tidewatt.functions.geography import region_of
from tidewatt.sources import supplied
from tidewatt.sources.tables import (
    source_electricity_prices,
    source_meter_readings,
    table_source,
)
from tidewatt.sources.files import (
    CURATED_PARTITION,
    existing_paths,
    list_files,
    malformed,
    partition_inventory,
    read_ndjson,
    read_parquet,
    well_formed,
)
from tidewatt.sources.ledger import FileLedger

NOW = datetime(2026, 8, 4, 12, tzinfo=UTC)


def reading(number, moment, **changes):
    record = {
        "event_id": f"0a1b2c3d-0000-4000-A000-{number:012d}",
        "schema_version": "1.0", "meter_id": "meter-1", "us_region": "Northeast",
        "state_code": "CT", "event_time": moment, "energy_kwh": 1.5, "voltage_v": 230.0,
        "current_a": 4.0, "power_factor": 0.95,
    }
    return json.dumps({**record, **changes})


def price(number, moment, value, **changes):
    record = {
        "price_id": f"0a1b2c3d-0000-4000-a000-{number:012d}", "schema_version": "1.0",
        "us_region": "Northeast", "state_code": "CT", "currency_code": "USD",
        "effective_from": moment, "price_per_kwh": value, "source_system": "tariff",
    }
    return json.dumps({**record, **changes})


def put(base, name, *lines):
    path = Path(base) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_ndjson_scan(spark, tmp_path):
    put(tmp_path, "day=1/a.json", '{"a":"1","b":2}', '{"a": oops', '{"a":3,"b":"x","c":9}')
    frame = read_ndjson(spark, str(tmp_path), ["a", "b", "missing"])
    assert rows(well_formed(frame), "a", "b", "missing") == [("1", "2", None), ("3", "x", None)]
    bad = malformed(frame).collect()
    assert len(bad) == 1 and "oops" in bad[0][0] and bad[0].source_file.endswith("a.json")


def test_listing_and_inventory(spark, tmp_path):
    for day in ("02", "01"):
        put(tmp_path, f"zone/year=2026/month=08/day={day}/part.parquet", "x")
    put(tmp_path, "zone/readme.txt", "x")
    assert list_files(spark, str(tmp_path)).count() == 3
    assert list_files(spark, str(tmp_path), ".parquet").count() == 2
    found = partition_inventory(list_files(spark, str(tmp_path)), "zone", CURATED_PARTITION)
    assert [r[0] for r in found.collect()] == [
        "zone/year=2026/month=08/day=01", "zone/year=2026/month=08/day=02"
    ]
    assert existing_paths(spark, [str(tmp_path), f"{tmp_path}/none"]) == [str(tmp_path)]


def test_ledger(spark, tmp_path):
    put(tmp_path, "raw/events/one.json", "{}")
    ledger = FileLedger.from_options(str(tmp_path / "ledger"), "stage")
    first = ledger.unseen(spark, str(tmp_path / "raw"), "json")
    ledger.commit(first, NOW, "run-1")
    put(tmp_path, "raw/events/two.json", "{}")
    found = ledger.unseen(spark, str(tmp_path / "raw"), "json").collect()
    assert [r.object_uri.rsplit("/", 1)[1] for r in found] == ["two.json"]
    row = ledger.processed(spark).first()
    assert (row.stage, row.job_run_id, str(row.completed_at)) == (
        "stage", "run-1", "2026-08-04 12:00:00"
    )
    other = FileLedger(ledger.path, "other")
    assert other.unseen(spark, str(tmp_path / "raw"), "json").count() == 2
    assert FileLedger.from_options(None, None) is None
    with pytest.raises(ValueError, match="supplied together"):
        FileLedger.from_options("table", None)


def test_dynamic_overwrite(spark, tmp_path):
    target = str(tmp_path / "out")
    frame = spark.createDataFrame([(0, "a"), (1, "b")], "p int, v string")
    write_partitioned(frame, target, ProcessingMode.INCREMENTAL, ["p"])
    fresh = spark.createDataFrame([(1, "c")], "p int, v string")
    write_partitioned(fresh, target, ProcessingMode.BACKFILL, ["p"], rebalance=True)
    assert rows(spark.read.parquet(target), "p", "v") == [("0", "a"), ("1", "c")]
    write_partitioned(fresh.limit(0), target, ProcessingMode.BACKFILL, ["p"])
    assert spark.read.parquet(target).count() == 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_quarantine_only_when_needed(spark, tmp_path):
    frame = spark.createDataFrame([("x", "quality", NOW)], "v string, error_type string, error_timestamp timestamp")
    assert write_rejected(frame.limit(0), str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()
    assert write_rejected(frame, str(tmp_path / "some")) is True
    folder = tmp_path / "some/error_type=quality/year=2026/month=08/day=04/hour=12"
    assert list(folder.glob("*.json"))


def test_merge_operators(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "k int, v string")
    assert rows(insert_only(target, source, ["k"], ["v"])) == [("1", "a"), ("2", "c")]
    for small in (False, True):
        assert rows(rows_to_insert(target, source, ["k"], ["v"], small)) == [("2", "c")]
    merged = upsert(target, source, ["k"], ["v"], ["v"])
    assert rows(merged, "k", "v", ACTION) == [("1", "b", "updated"), ("2", "d", "inserted")]
    assert rows(upsert(target, source.limit(0), ["k"], ["v"]), ACTION) == [("kept",)]


def test_snapshot_table(spark, tmp_path):
    table = curation.prices_table(str(tmp_path / "prices"))
    def batch(price_id, day, value, loaded):
        return spark.createDataFrame(
            [(price_id, "1.0", "Northeast", "CT", "USD", at(f"2026-01-{day}T00:00:00"), value, "s",
              at(loaded), "2026", "01", day)],
            "price_id string, schema_version string, us_region string, state_code string,"
            " currency_code string, effective_from timestamp, price double, source_system string,"
            " load_datetime timestamp, year string, month string, day string",
        ).withColumn("price_per_kwh", F.col("price").cast("decimal(10,4)")).drop("price")
    keys, updated = ["state_code", "effective_from"], ["price_per_kwh", "load_datetime"]
    assert table.read(spark).count() == 0
    stats = table.upsert(batch("p1", "01", 0.1, "2026-01-01T01:00:00"), keys, updated)
    assert (stats.inserted, stats.updated) == (1, 0)
    table.upsert(batch("p2", "02", 0.2, "2026-01-02T01:00:00"), keys, updated)
    stats = table.upsert(batch("p9", "01", 0.3, "2026-01-03T01:00:00"), keys, updated)
    assert (stats.inserted, stats.updated) == (0, 1)
    assert rows(table.read(spark), "price_id", "price_per_kwh", "load_datetime", "day") == [
        ("p1", "0.3000", "2026-01-03 01:00:00", "01"), ("p2", "0.2000", "2026-01-02 01:00:00", "02")
    ]


def test_constraints(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    with pytest.raises(ConstraintViolation, match="not_null:v=1"):
        enforce([not_null("t", "v"), unique("t", "k")], {"t": frame})
    enforce(warehouse_constraints("t", "v", ["k"]), {"t": frame.filter("v is not null")})
    guarded = SnapshotTable(str(tmp_path / "t"), frame.schema, checks=(not_null("new_rows", "v"),))
    with pytest.raises(ConstraintViolation):
        guarded.insert_new(frame, ["k"], ["v"])
    assert guarded.insert_new(frame.filter("v = 'x'"), ["k"]).inserted == 1
    assert guarded.insert_new(frame.filter("v = 'x'"), ["k"]).inserted == 0


def test_materialisations(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    materialize(frame, "a_view")
    assert spark.table("a_view").count() == 1
    materialize(frame, "a_table", "table", bucket_by=["k"], buckets=2)
    materialize(frame, "a_table_2", "incremental")
    materialize(frame, "a_table_2", "incremental")
    assert spark.table("a_table").count() == 1 and spark.table("a_table_2").count() == 2
    with pytest.raises(ValueError, match="kind must be"):
        materialize(frame, "x", "stream")
    assert rows(stored(frame, "copy")) == [("1", "a")]
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_reading_jobs_end_to_end(spark, tmp_path):
    raw, curated, errors = (str(tmp_path / n) for n in ("raw", "curated", "errors"))
    put(
        raw, "year=2026/month=08/day=03/hour=14/a.json",
        reading(1, "2026-08-03T14:00:00Z"), reading(1, "2026-08-03T14:00:00Z"),
        reading(2, "2026-08-03T23:30:00-02:00"), reading(3, "2026-08-03T15:00:00Z", energy_kwh=-1),
        '{"event_id": oops',
    )
    ledger = FileLedger(str(tmp_path / "ledger"), "raw")
    run = curation.JobRun("r1", NOW, ledger=ledger, run_log=str(tmp_path / "log"))
    job = lambda run: curation.raw_to_curated(
        spark, curation.RAW_READING_STREAM, run, raw, curated, errors
    )
    summary = job(run)
    assert (summary["rows"], summary["malformed"], summary["rejected"]) == (5, 1, 1)
    assert sorted(p.name for p in (tmp_path / "curated/year=2026/month=08").iterdir()) == [
        "day=03", "day=04"
    ]
    assert job(run)["processed_batches"] == 0
    put(raw, "year=2026/month=08/day=04/hour=01/b.json", reading(4, "2026-08-04T01:00:00Z"))
    assert job(curation.incremental(run, "r2", NOW))["rows"] == 1
    rejected = spark.read.json(errors)
    assert rows(rejected, "error_type", "error_stage") == [
        ("dynamic_frame", "smart_meter_raw_to_curated"), ("quality", "smart_meter_raw_to_curated")
    ]
    assert spark.read.text(str(tmp_path / "log")).count() == 3

    table = curation.readings_table(str(tmp_path / "table"))
    load = lambda name: curation.curated_to_warehouse(
        spark, curation.CURATED_READING_STREAM, curation.JobRun(name, NOW), curated, table, errors
    )
    assert load("l1")["inserted"] == 3
    assert load("l2")["inserted"] == 0
    stored_rows = table.read(spark)
    assert rows(stored_rows, "event_id", "energy_kwh", "object_key", "bucket_name", "day")[0] == (
        "0a1b2c3d-0000-4000-a000-000000000001", "1.50000",
        "year=2026/month=08/day=03/hour=14/a.json", "raw", "03",
    )


def test_backfill_replaces_its_window_only(spark, tmp_path):
    raw, curated, errors = (str(tmp_path / n) for n in ("raw", "curated", "errors"))
    for day in ("01", "02", "03"):
        put(raw, f"year=2026/month=08/day={day}/backfill.json",
            reading(int(day), f"2026-08-{day}T05:00:00Z"),
            reading(100 + int(day), "not a time"))
    job = lambda run: curation.raw_to_curated(
        spark, curation.RAW_READING_STREAM, run, raw, curated, errors
    )
    window = BackfillWindow.parse("2026-08-01T00:00:00Z", "2026-08-03T00:00:00Z", "day")
    run = curation.JobRun("b", NOW, ProcessingMode.BACKFILL, window)
    assert job(run)["processed_batches"] == 2
    assert job(run)["processed_batches"] == 2
    found = read_parquet(spark, curated, curation.curated_schema(curation.CURATED_READING_STREAM))
    assert rows(found, "event_time", "day") == [
        ("2026-08-01 05:00:00", "01"), ("2026-08-02 05:00:00", "02")
    ]
    # Two runs over two days: each unreadable row is reported once per run.
    assert spark.read.json(errors).count() == 4
    table = curation.readings_table(str(tmp_path / "table"))
    load = curation.curated_to_warehouse(
        spark, curation.CURATED_READING_STREAM,
        curation.JobRun("w", NOW, ProcessingMode.BACKFILL, window), curated, table, errors,
    )
    assert load["inserted"] == 2
    with pytest.raises(ValueError, match="backfill needs a window"):
        curation.JobRun("b", NOW, ProcessingMode.BACKFILL)


def test_price_jobs(spark, tmp_path):
    raw, curated, errors = (str(tmp_path / n) for n in ("raw", "curated", "errors"))
    put(raw, "year=2026/month=08/day=03/a.json", price(1, "2026-08-03T00:00:00Z", 0.27),
        price(2, "2026-08-03T01:00:00Z", -1))
    run = curation.JobRun("r", NOW)
    job = lambda: curation.raw_to_curated(
        spark, curation.RAW_PRICE_STREAM, run, raw, curated, errors
    )
    assert job()["rejected"] == 1
    table = curation.prices_table(str(tmp_path / "table"))
    load = lambda: curation.curated_to_warehouse(
        spark, curation.CURATED_PRICE_STREAM, run, curated, table, errors
    )
    assert load()["inserted"] == 1
    put(raw, "year=2026/month=08/day=03/a.json", price(3, "2026-08-03T00:00:00Z", 0.3))
    job()
    summary = load()
    assert (summary["inserted"], summary["updated"]) == (0, 1)
    assert rows(table.read(spark), "price_id", "price_per_kwh") == [
        ("0a1b2c3d-0000-4000-a000-000000000001", "0.3000")
    ]


def test_summary(spark, tmp_path):
    found = emit_summary(
        spark, str(tmp_path / "log"), job="j", run_id="1", started_at=NOW, finished_at=NOW, rows=3
    )
    assert found["duration_seconds"] == 0 and found["rows"] == 3
    assert json.loads(spark.read.text(str(tmp_path / "log")).first()[0])["job"] == "j"


def test_jdbc_staging_options():
    target = JdbcStaging("jdbc:x", "stage.prices", "u", "p", batch_size=2)
    assert target.options()["batchsize"] == "2" and target.options()["queryTimeout"] == "300"
    with pytest.raises(ValueError, match="one row at least"):
        JdbcStaging("jdbc:x", "t", "u", "p", batch_size=0)


def test_table_sources(spark, small):
    readings = supplied.readings(spark, small).withColumn("extra", F.lit(1))
    readings.createOrReplaceTempView("core_readings")
    source = source_meter_readings(table_source(spark, "core_readings"))
    assert len(source.columns) == 15 and "extra" not in source.columns
    assert len(source_electricity_prices(supplied.prices(spark, small)).columns) == 9
    states = spark.createDataFrame([("TX",), ("ZZ",)], "s string")
    assert [r[0] for r in states.select(region_of(F.col("s"))).collect()] == ["South", None]


@pytest.mark.parametrize("partition_by", [(), ("zone",)])
def test_upsert_survives_a_failure_between_its_writes(spark, tmp_path, monkeypatch, partition_by):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "zone", "value")])
    table = SnapshotTable(str(tmp_path / "prices"), schema, partition_by)
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    table.upsert(frame(("1", "a", "x"), ("2", "a", "x"), ("3", "b", "x")), ["id"], ["value"])
    write, calls = SnapshotTable._write, []

    def failing(self, rows, path, mode, dynamic=False):
        calls.append(path)
        if len(calls) == 2:
            # The worst moment: what was to be replaced is gone, nothing is written yet.
            shutil.rmtree(table.path if not partition_by else f"{table.path}/zone=a")
            raise OSError("lost")
        write(self, rows, path, mode, dynamic)

    monkeypatch.setattr(SnapshotTable, "_write", failing)
    with pytest.raises(OSError, match="lost"):
        table.upsert(frame(("2", "a", "y"), ("4", "a", "y")), ["id"], ["value"])
    monkeypatch.setattr(SnapshotTable, "_write", write)
    expected = [("1", "a", "x"), ("2", "a", "y"), ("3", "b", "x"), ("4", "a", "y")]
    assert rows(table.read(spark), "id", "zone", "value") == expected
    table.upsert(frame(("2", "a", "y"), ("4", "a", "y")), ["id"], ["value"])
    assert rows(table.read(spark), "id", "zone", "value") == expected


@pytest.mark.parametrize("partition_by", [(), ("zone",)])
def test_upsert_without_success_files(spark, tmp_path, partition_by):
    """The merge has a marker of its own; the cluster may switch the writer's off."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "zone", "value")])
    table = SnapshotTable(str(tmp_path / "prices"), schema, partition_by)
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    conf, name = spark._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    try:
        assert table.upsert(frame(("1", "a", "x"), ("2", "b", "x")), ["id"], ["value"]).inserted == 2
        stats = table.upsert(frame(("2", "b", "y"), ("3", "b", "z")), ["id"], ["value"])
    finally:
        conf.unset(name)
    assert (stats.inserted, stats.updated) == (1, 1)
    assert rows(table.read(spark), "id", "value") == [("1", "x"), ("2", "y"), ("3", "z")]


def test_a_staging_folder_without_marker_changes_nothing(spark, tmp_path, monkeypatch):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "value")])
    table = SnapshotTable(str(tmp_path / "t"), schema)
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    table.upsert(frame(("1", "x")), ["id"], ["value"])
    monkeypatch.setattr("tidewatt.sinks.tables.put_marker", lambda spark, path: None)
    with pytest.raises(UnfinishedMerge):
        table.upsert(frame(("1", "y")), ["id"], ["value"])
    assert rows(table.read(spark)) == [("1", "x")]
    monkeypatch.undo()
    table.upsert(frame(("1", "z")), ["id"], ["value"])
    assert rows(table.read(spark)) == [("1", "z")]
