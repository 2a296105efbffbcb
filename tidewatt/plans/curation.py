"""Raw-to-curated and curated-to-warehouse jobs of the two event streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.contracts import (
    PRICE_FIELDS,
    READING_FIELDS,
    REGIONS,
    SCHEMA_VERSIONS,
    STATE_REGION_KEYS,
    STATES,
    UUID_PATTERN,
)
from tidewatt.functions.calendar import instant, partition_fields
from tidewatt.operators.checks import Check, accepted_range, not_null, unique
from tidewatt.operators.keyed import first_by_key
from tidewatt.operators.mapping import ColumnMapping, map_columns
from tidewatt.operators.validation import (
    REASONS,
    RecordContract,
    ValidationRule,
    judged,
)
from tidewatt.operators.windows import BackfillGrain, BackfillWindow, ProcessingMode
from tidewatt.session import work_folder
from tidewatt.sinks.partitioned import write_partitioned, write_quarantine
from tidewatt.sinks.run_log import emit_summary
from tidewatt.sinks.tables import MergeStats, SnapshotTable
from tidewatt.sources.files import (
    CORRUPT,
    SOURCE_FILE,
    existing_paths,
    folder_day,
    object_key,
    read_ndjson,
    read_parquet,
    well_formed,
)
from tidewatt.sources.ledger import FileLedger

PARTITIONS = ("year", "month", "day")
# Fixed value: folder name of records that could not be parsed.
MALFORMED = "dynamic_frame"


def location(bucket: str, prefix: str, scheme: str = "s3") -> str:
    """``bucket`` and ``prefix`` as one folder URI, tolerant of stray slashes and schemes."""
    name = bucket.removeprefix(f"{scheme}://").strip("/")
    if not name:
        raise ValueError("a location needs the name of a bucket")
    return "/".join([f"{scheme}:/", *filter(None, [name, prefix.strip("/")]), ""])


def _zone_rules(id_column: str, region: str, state: str, alignment: str) -> list[ValidationRule]:
    pair = lambda: F.concat_ws(":", "state_code", "us_region")
    return [
        ValidationRule(f"format:{id_column}_uuid", lambda: F.col(id_column).rlike(UUID_PATTERN)),
        ValidationRule(
            "schema:supported_version", lambda: F.col("schema_version").isin(*SCHEMA_VERSIONS)
        ),
        ValidationRule(region, lambda: F.col("us_region").isin(*REGIONS)),
        ValidationRule(state, lambda: F.col("state_code").isin(*STATES)),
        ValidationRule(alignment, lambda: pair().isin(*STATE_REGION_KEYS)),
    ]


def _not_negative(column: str, name: str | None = None) -> ValidationRule:
    return ValidationRule(name or f"range:{column}", lambda: F.col(column) >= 0)


_READING_ZONE = _zone_rules(
    "event_id", "domain:us_census_region", "domain:us_state_code", "domain:state_region_alignment"
)
_PRICE_RULES = [
    *_zone_rules("price_id", "region:us_census", "state:supported_code", "region:state_alignment"),
    _not_negative("price_per_kwh", "range:price"),
]
_AUDIT = (
    ("raw_bucket", "bucket_name", "string"),
    ("raw_object_key", "object_key", "string"),
    ("raw_line_number", "source_line_number", "int"),
    ("record_source", "record_source", "string"),
)


def _mappings(fields, id_column: str, extra=()) -> tuple[ColumnMapping, ...]:
    own = [ColumnMapping(name, name, kind, lower=name == id_column) for name, kind, _ in fields]
    return tuple(own + [ColumnMapping(*item) for item in extra])


def _contract(mappings: tuple[ColumnMapping, ...], rules) -> RecordContract:
    return RecordContract(mappings, tuple(m.target for m in mappings), tuple(rules))


RAW_READINGS = _contract(
    _mappings(READING_FIELDS, "event_id"),
    [
        *_READING_ZONE,
        _not_negative("energy_kwh"),
        _not_negative("voltage_v"),
        _not_negative("current_a"),
        ValidationRule("range:power_factor", lambda: F.col("power_factor").between(0, 1)),
    ],
)
RAW_PRICES = _contract(_mappings(PRICE_FIELDS, "price_id"), _PRICE_RULES)
# The warehouse load checks identity and zone again, not the measured ranges.
CURATED_READINGS = _contract(_mappings(READING_FIELDS, "event_id", _AUDIT), _READING_ZONE)
CURATED_PRICES = _contract(_mappings(PRICE_FIELDS, "price_id"), _PRICE_RULES)


@dataclass(frozen=True)
class Stream:
    """What distinguishes the two streams inside one job."""

    name: str
    contract: RecordContract
    id_column: str
    time_column: str
    error_type: str = "quality"


RAW_READING_STREAM = Stream("smart_meter_raw_to_curated", RAW_READINGS, "event_id", "event_time")
RAW_PRICE_STREAM = Stream("prices_raw_to_curated", RAW_PRICES, "price_id", "effective_from")
CURATED_READING_STREAM = Stream(
    "smart_meter_curated_to_warehouse", CURATED_READINGS, "event_id", "event_time", "validation"
)
CURATED_PRICE_STREAM = Stream(
    "prices_curated_to_warehouse", CURATED_PRICES, "price_id", "effective_from"
)


@dataclass(frozen=True)
class JobRun:
    """Arguments of one run. ``load_ts`` stands for the wall clock everywhere."""

    run_id: str
    load_ts: datetime
    mode: ProcessingMode = ProcessingMode.INCREMENTAL
    window: BackfillWindow | None = None
    ledger: FileLedger | None = None
    run_log: str | None = None

    def __post_init__(self) -> None:
        if (self.mode is ProcessingMode.BACKFILL) != (self.window is not None):
            raise ValueError("a backfill needs a window and an incremental run has none")

    def batches(self) -> tuple[BackfillWindow | None, ...]:
        return self.window.batches() if self.window else (None,)


def reading_audit(root: str) -> dict[str, Column]:
    """Lineage columns. Line numbers cannot be known in a split scan and stay 0.

    The bucket is the host of a URI, or the folder itself on a plain path.
    """
    source = F.col(SOURCE_FILE)
    scheme, separator, rest = root.partition("://")
    bucket = rest.strip("/").split("/")[0] if separator else root.strip("/")
    return {
        "raw_bucket": F.lit(bucket.split("/")[-1]),
        "raw_object_key": object_key(source, bucket),
        "raw_line_number": F.lit(0).cast("long"),
        "record_source": source,
    }


def _unseen(spark: SparkSession, run: JobRun, source: str, data_format: str):
    """Files to read in an incremental run: (paths, rows for the ledger)."""
    if run.ledger is None:
        return [source], None
    # Written down first: files arriving while the job runs must not be marked as done.
    pending = work_folder(spark, "pending")
    run.ledger.unseen(spark, source, data_format).write.parquet(pending)
    files = spark.read.schema("object_uri string").parquet(pending).orderBy("object_uri")
    # File names only; Spark's own scan keeps the same list on the driver.
    return [row.object_uri for row in files.toLocalIterator()], files


def _inside(window: BackfillWindow | None, file: Column, moment: Column | None = None) -> Column:
    """A row belongs to a batch by its time, or by its folder when the time is unreadable."""
    if window is None:
        return F.lit(True)
    day = folder_day(file)
    if moment is not None:
        day = F.coalesce(F.date_format(moment, "yyyy-MM-dd"), day)
    return day.isNull() | ((day >= window.start.isoformat()) & (day < window.end.isoformat()))


def _refused(
    frame: DataFrame, stream: Stream, run: JobRun, window: BackfillWindow | None, audit: dict[str, Column]
) -> DataFrame:
    """Malformed and rejected records of a scan in one pass, each with the fields it has."""
    columns = {**audit, "__file": F.col(SOURCE_FILE)}
    facts = {"error_stage": F.lit(stream.name), "error_timestamp": instant(run.load_ts)}
    if CORRUPT not in frame.columns:
        checked = judged(map_columns(frame, stream.contract.mappings, columns), stream.contract)
        own = _inside(window, F.col("__file"), F.col(stream.time_column))
        return checked.filter(own & (F.size(REASONS) > 0)).drop("__file").withColumns({"error_type": F.lit(stream.error_type), **facts})
    lost = F.col("record").isNotNull()
    raw = [name for name in frame.columns if name not in (CORRUPT, SOURCE_FILE)]
    broken = F.col(CORRUPT).isNotNull()
    mapped = map_columns(
        frame,
        stream.contract.mappings,
        {**columns, "record": F.col(CORRUPT), "parsed_fields": F.when(broken, F.to_json(F.struct(*raw)))},
    )
    own = _inside(window, F.col("__file"), F.when(~lost, F.col(stream.time_column)))
    refused = judged(mapped, stream.contract).filter(own & (lost | (F.size(REASONS) > 0)))
    targets = [mapping.target for mapping in stream.contract.mappings]
    # A malformed record keeps its text, its file and what could be parsed; the writer leaves out nulls.
    only = {name: F.when(~lost, F.col(name)) for name in [*targets, *audit]}
    only["record_source"] = F.when(lost, F.col("__file")).otherwise(F.col("record_source") if "record_source" in refused.columns else F.lit(None))
    reasons = F.when(lost, F.array(F.lit("malformed"))).otherwise(F.col(REASONS))
    kind = F.when(lost, MALFORMED).otherwise(stream.error_type)
    return refused.withColumns({**only, REASONS: reasons, "error_type": kind, **facts}).drop("__file")


def _run(
    spark: SparkSession,
    stream: Stream,
    run: JobRun,
    scan: Callable[[BackfillWindow | None, list[str] | None], DataFrame | None],
    source: str,
    data_format: str,
    errors: str,
    audit: dict[str, Column],
    sink: Callable[[DataFrame, BackfillWindow | None], MergeStats | None],
) -> dict[str, object]:
    """Shared shape of the four jobs. One pass writes the valid rows and counts the others on
    the way; a second pass over the source happens only when there is something to reject."""
    started = datetime.now(UTC)
    totals = {"rows": 0, "malformed": 0, "rejected": 0, "inserted": 0, "updated": 0}
    batches = 0
    ledger_rows = None
    for window in run.batches():
        paths = None
        if window is None:
            paths, ledger_rows = _unseen(spark, run, source, data_format)
            if not paths:
                continue
        frame = scan(window, paths)
        if frame is None:
            continue
        before, after = Observation(), Observation()
        has_corrupt = CORRUPT in frame.columns
        watched = frame
        if has_corrupt:
            lost = F.col(CORRUPT).isNotNull() & _inside(window, F.col(SOURCE_FILE))
            watched = frame.observe(before, F.count_if(lost).alias("malformed"))
        parsed = well_formed(watched) if has_corrupt else watched
        columns = {**audit, "__file": F.col(SOURCE_FILE)}
        own = _inside(window, F.col("__file"), F.col(stream.time_column))
        checked = judged(map_columns(parsed, stream.contract.mappings, columns), stream.contract).observe(
            after,
            F.count_if(own).alias("parsed"),
            F.count_if(own & (F.size(REASONS) > 0)).alias("rejected"),
        )
        valid = checked.filter(F.size(REASONS) == 0).drop(REASONS, "__file")
        if window is not None:
            valid = window.filter(valid, stream.time_column)
        valid = first_by_key(valid, [stream.id_column], [F.col(stream.time_column).asc()])
        stats = sink(valid, window)
        seen = {**(before.get if has_corrupt else {}), **after.get}
        seen["rows"] = (seen.get("parsed") or 0) + (seen.get("malformed") or 0)
        if seen.get("malformed") or seen.get("rejected"):
            write_quarantine(_refused(frame, stream, run, window, audit), errors)
        for name in ("rows", "malformed", "rejected"):
            totals[name] += seen.get(name, 0) or 0
        if stats is not None:
            totals["inserted"] += stats.inserted
            totals["updated"] += stats.updated
        batches += 1
    summary = emit_summary(
        spark,
        run.run_log,
        job=stream.name,
        run_id=run.run_id,
        started_at=started,
        finished_at=datetime.now(UTC),
        processing_mode=run.mode.value,
        source_uri=source,
        processed_batches=batches,
        **totals,
    )
    if run.ledger is not None and ledger_rows is not None and batches:
        run.ledger.commit(ledger_rows, run.load_ts, run.run_id)
    return summary


def raw_to_curated(
    spark: SparkSession, stream: Stream, run: JobRun, source: str, target: str, errors: str
) -> dict[str, object]:
    """NDJSON to validated, de-duplicated Parquet by UTC day."""
    fields = [mapping.source for mapping in stream.contract.mappings]

    def scan(window: BackfillWindow | None, paths: list[str] | None) -> DataFrame | None:
        if window is not None:
            paths = existing_paths(spark, window.scan_paths(source))
        return read_ndjson(spark, paths, fields) if paths else None

    def sink(valid: DataFrame, window: BackfillWindow | None) -> None:
        curated = valid.withColumns(partition_fields(F.col(stream.time_column)))
        # A day batch is one folder already. Late records and wide windows touch many folders;
        # gathering them avoids a small file per task and folder.
        several_days = window is None or window.grain is not BackfillGrain.DAY
        write_partitioned(curated, target, run.mode, PARTITIONS, rebalance=several_days)

    audit = reading_audit(source) if stream.id_column == "event_id" else {}
    return _run(spark, stream, run, scan, source, "json", errors, audit, sink)


def curated_schema(stream: Stream) -> T.StructType:
    """Schema of the curated zone, with partition columns kept as text."""
    kinds = {"string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType()}
    audit = {"source_line_number": T.LongType()}
    fields = [
        T.StructField(m.source, audit.get(m.target) or kinds.get(m.data_type, T.LongType()))
        for m in stream.contract.mappings
    ]
    return T.StructType(fields + [T.StructField(name, T.StringType()) for name in PARTITIONS])


def _warehouse_columns(fields, load_ts: datetime) -> dict[str, Column]:
    """Exact decimals of the warehouse; an overflow fails the load, as a numeric column does."""
    typed = {
        name: F.col(name).cast(kind) for name, _, kind in fields if kind.startswith("decimal")
    }
    return {**typed, "load_datetime": instant(load_ts)}


def curated_to_warehouse(
    spark: SparkSession,
    stream: Stream,
    run: JobRun,
    source: str,
    table: SnapshotTable,
    errors: str,
) -> dict[str, object]:
    """Merge curated rows: readings insert-only by id, prices update by (state, start)."""
    readings = stream.id_column == "event_id"
    fields = READING_FIELDS if readings else PRICE_FIELDS

    def scan(window: BackfillWindow | None, paths: list[str] | None) -> DataFrame | None:
        frame = read_parquet(spark, paths or source, curated_schema(stream), source)
        return window.partition_filter(frame) if window is not None else frame

    def sink(valid: DataFrame, window: BackfillWindow | None) -> MergeStats:
        typed = valid.withColumns(_warehouse_columns(fields, run.load_ts))
        if table.partition_by:
            typed = typed.withColumns(partition_fields(F.col(stream.time_column)))
        if readings:
            small = run.mode is ProcessingMode.INCREMENTAL
            return table.insert_new(typed, ["event_id"], ["event_time"], small_batch=small)
        return table.upsert(
            typed,
            ["state_code", "effective_from"],
            ["price_per_kwh", "source_system", "load_datetime"],
            ["price_id"],
        )

    return _run(spark, stream, run, scan, source, "parquet", errors, {}, sink)


def _table_schema(fields, extra: str, partition_by) -> T.StructType:
    columns = [f"{name} {kind}" for name, _, kind in fields]
    columns += [part for part in (extra, "load_datetime timestamp") if part]
    columns += [f"{name} string" for name in partition_by]
    return T.StructType.fromDDL(", ".join(columns))


def _constraints(fields, extra: Sequence[str], keys: Sequence[Sequence[str]]) -> tuple[Check, ...]:
    """Every column is there and every key occurs once among the rows of a load.

    That no key is in the table already is what the merges see to.
    """
    required = [name for name, _, _ in fields] + [*extra, "load_datetime"]
    return (*[not_null("new_rows", name) for name in required], *[unique("new_rows", *key) for key in keys])


def readings_table(path: str, partition_by: tuple[str, ...] = PARTITIONS) -> SnapshotTable:
    extra = "bucket_name string, object_key string, source_line_number int, record_source string"
    names = [part.split()[0] for part in extra.split(", ")]
    checks = _constraints(READING_FIELDS, names, [("event_id",)])
    return SnapshotTable(path, _table_schema(READING_FIELDS, extra, partition_by), partition_by, checks)


def prices_table(path: str, partition_by: tuple[str, ...] = PARTITIONS) -> SnapshotTable:
    checks = _constraints(PRICE_FIELDS, (), [("price_id",), ("state_code", "effective_from")])
    checks += (accepted_range("new_rows", "price_per_kwh", 0),)
    return SnapshotTable(path, _table_schema(PRICE_FIELDS, "", partition_by), partition_by, checks)


def incremental(run: JobRun, run_id: str, load_ts: datetime) -> JobRun:
    """The next scheduled run with the same ledger and log."""
    return replace(run, run_id=run_id, load_ts=load_ts)
