import json
from pathlib import Path

from frames import rows
from pyspark.sql import functions as F

from tidewatt.operators.asof import asof_join, effective_intervals
from tidewatt.registry.queries import QUERIES, stream_hourly, stream_hourly_all, stream_priced_all
from tidewatt.sources import supplied
from tidewatt.streaming import flows

FIELDS = ["event_id", "event_time", "kwh"]


def put(folder, name, *lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("\n".join(lines) + "\n")


def event(number, moment, kwh="1.0"):
    return json.dumps({"event_id": str(number), "event_time": moment, "kwh": kwh})


def test_landing_restarts_and_late_records(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "landing")
    put(source, "a.json", event(1, "2026-08-03T14:59:00Z"), '{"event_id": oops')

    def run():
        stream = flows.ndjson_stream(spark, source, FIELDS, flows.LOCAL_BUFFER)
        flows.start_landing(stream, "event_time", target, str(tmp_path / "cp")).awaitTermination()
        flows.start_error_landing(
            stream, str(tmp_path / "err"), str(tmp_path / "cp-err")
        ).awaitTermination()

    run()
    assert spark.read.json(target).count() == 1
    run()
    assert spark.read.json(target).count() == 1
    put(source, "b.json", event(2, "2026-08-01T02:00:00Z"))
    run()
    assert spark.read.json(target).count() == 2
    assert (tmp_path / "landing/year=2026/month=08/day=01/hour=02").exists()
    bad = spark.read.json(str(tmp_path / "err"))
    assert rows(bad, "record", "error_type") == [('{"event_id": oops', "processing-failed")]


def test_buffers():
    assert flows.LOCAL_BUFFER.trigger() == {"processingTime": "5 seconds"}
    assert flows.DEFAULT_BUFFER.read_options() == {"maxBytesPerTrigger": "67108864"}


def _stream(spark, small):
    schema = supplied.table(spark, small, "events").schema
    return flows.parquet_stream(spark, small, schema, "events.parquet").withColumn(
        "moment", F.col("ts").cast("timestamp")
    )


def test_hourly_totals_equal_batch_on_closed_windows(spark, small):
    exact = lambda frame: frame.withColumn("amount", F.col("value").cast("decimal(12,5)"))
    totals = flows.hourly_totals(exact(_stream(spark, small)), "moment", ["event_type"], {"amount": "amount"})
    found = flows.run_available(totals)
    batch = exact(supplied.table(spark, small, "events")).withColumn("moment", F.col("ts").cast("timestamp"))
    closed = batch.agg(F.max("moment")).scalar() - F.expr("interval 1 hour")
    expected = (
        batch.groupBy(F.date_trunc("hour", "moment").alias("reading_hour"), "event_type")
        .agg(F.sum("amount").alias("amount"), F.count("*").alias("reading_count"))
        .filter(F.col("reading_hour") + F.expr("interval 1 hour") <= closed)
    )
    assert rows(found, *expected.columns) == rows(expected)
    assert 0 < expected.count() < 951


def test_deduplication(spark, small):
    once = _stream(spark, small).select("event_id", "moment")
    twice = once.unionByName(_stream(spark, small).select("event_id", "moment"))
    found = flows.run_available(flows.deduplicated(twice, ["event_id"], "moment"))
    assert found.count() == found.select("event_id").distinct().count() == 1000


def test_stream_pricing_equals_batch(spark, small):
    events = supplied.table(spark, small, "events")
    shape = lambda frame: frame.filter("event_type <> 'purchase'").select(
        "event_id", F.lit("S").alias("state_code"), F.lit("R").alias("us_region"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )
    tariffs = effective_intervals(
        events.filter("event_type = 'purchase'").select(
            F.lit("S").alias("state_code"), F.lit("R").alias("us_region"),
            F.col("ts").cast("timestamp").alias("price_effective_from"),
            F.col("event_id").alias("price_id"),
        ),
        ["state_code"], "price_effective_from", "effective_to",
    )
    found = flows.run_available(
        flows.priced(shape(_stream(spark, small)), tariffs).select("event_id", "price_id")
    )
    batch = asof_join(
        shape(events), tariffs, by=["state_code"], also=["us_region"], left_ts="event_time",
        valid_from="price_effective_from", valid_to="effective_to",
    )
    assert rows(found) == rows(batch, "event_id", "price_id")


def _out_of_order(spark, tmp_path):
    """A stream of three files, the second two days older than the first; a key comes twice, far
    apart, and one row has no time."""
    source = str(tmp_path / "events")
    for rows_of_file in (
        [(1, "2026-08-03 14:10:00", 1), (2, "2026-08-03 14:50:00", 2)],
        [(3, "2026-08-01 02:30:00", 4), (1, "2026-07-20 00:00:00", 8)],
        [(4, "2026-08-03 15:20:00", 16), (5, None, 32)],
    ):
        spark.createDataFrame(rows_of_file, "id int, moment string, amount int").withColumn(
            "moment", F.col("moment").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(source)
    schema = "id int, moment timestamp, amount int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_late_rows_and_open_hours_are_in_the_hour_table(spark, tmp_path):
    landed = flows.run_available(_out_of_order(spark, tmp_path), folder=str(tmp_path / "work"))
    hours = flows.hour_table(landed, "moment", [], {"amount": "amount"})
    closed = flows.closed_hours(hours, landed, "moment")
    hour = F.coalesce(F.col("reading_hour").cast("string"), F.lit("none"))
    text = lambda frame: set(rows(frame.withColumn("reading_hour", hour)))
    old = {("2026-07-20 00:00:00", "8", "1"), ("2026-08-01 02:00:00", "4", "1")}
    last = {("2026-08-03 14:00:00", "3", "2"), ("2026-08-03 15:00:00", "16", "1"), ("none", "32", "1")}
    assert text(hours) == old | last
    assert text(closed) == old


def test_unique_rows_keep_late_keys_and_drop_distant_duplicates(spark, tmp_path):
    landed = flows.run_available(_out_of_order(spark, tmp_path), folder=str(tmp_path / "work"))
    found = flows.unique_rows(landed, ["id"], "moment")
    assert {(r.id, r.amount) for r in found.collect()} == {(1, 8), (2, 2), (3, 4), (4, 16), (5, 32)}


def test_registered_streams_publish_every_row(spark, small):
    events = supplied.table(spark, small, "events")
    counted = stream_hourly_all(spark, small).agg(F.sum("reading_count")).first()[0]
    assert counted == events.count() > stream_hourly(spark, small).agg(F.sum("reading_count")).first()[0]
    readings = stream_priced_all(spark, small).agg(F.sum("reading_count")).first()[0]
    assert readings == QUERIES["asof_priced"](spark, small).count()
