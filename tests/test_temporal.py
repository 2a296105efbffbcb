import random
from datetime import UTC, datetime

import pytest
from frames import at, plan, rows
from pyspark.sql import functions as F

from tidewatt.operators.asof import BLOCK, LEVEL, asof_join, dyadic_blocks, effective_intervals
from tidewatt.operators.timeline import with_carried, with_next_start, with_previous
from tidewatt.plans import information
from tidewatt.sources import supplied

STRATEGIES = ["bucket", "shuffle", "dyadic", "carry"]


def tariffs(spark, values):
    frame = spark.createDataFrame(
        [(s, r, at(t), p) for s, r, t, p in values],
        "state string, region string, valid_from timestamp, price double",
    )
    return effective_intervals(frame, ["state"], "valid_from", "valid_to")


def readings(spark, values):
    return spark.createDataFrame(
        [(i, s, r, at(t) if t else None) for i, s, r, t in values],
        "id int, state string, region string, moment timestamp",
    )


def join(left, right, how="left", strategy="bucket", **options):
    return asof_join(
        left, right, by=["state"], also=["region"], left_ts="moment", valid_from="valid_from",
        valid_to="valid_to", how=how, strategy=strategy, **options,
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_interval_boundaries(spark, strategy):
    right = tariffs(
        spark,
        [("CT", "N", "2026-01-02T00:00:00", 1.0), ("CT", "N", "2026-01-02T01:00:00", 2.0)],
    )
    left = readings(
        spark,
        [
            (1, "CT", "N", "2026-01-02T00:59:00"),
            (2, "CT", "N", "2026-01-02T01:00:00"),
            (3, "CT", "N", "2026-01-02T09:00:00"),
            (4, "CT", "N", "2026-01-01T12:00:00"),
            (5, "NY", "N", "2026-01-02T09:00:00"),
            (6, "CT", "N", None),
            (7, None, "N", "2026-01-02T09:00:00"),
        ],
    )
    expected = {1: 1.0, 2: 2.0, 3: 2.0, 4: None, 5: None, 6: None, 7: None}
    found = {r.id: r.price for r in join(left, right, "left", strategy).collect()}
    assert found == expected
    inner = {r.id: r.price for r in join(left, right, "inner", strategy).collect()}
    assert inner == {k: v for k, v in expected.items() if v is not None}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_region_mismatch_does_not_fall_back(spark, strategy):
    right = tariffs(
        spark,
        [("CT", "N", "2026-01-01T00:00:00", 1.0), ("CT", "W", "2026-01-02T00:00:00", 2.0)],
    )
    left = readings(
        spark, [(1, "CT", "N", "2026-01-01T05:00:00"), (2, "CT", "N", "2026-01-03T00:00:00")]
    )
    found = {r.id: r.price for r in join(left, right, "left", strategy).collect()}
    assert found == {1: 1.0, 2: None}


def test_strategies_agree_on_supplied_data(spark, small):
    left = supplied.readings(spark, small)
    right = effective_intervals(
        supplied.prices(spark, small), ["state_code"], "effective_from", "effective_to"
    )
    results = {
        strategy: rows(
            information.int_meter_readings_priced(left, right, strategy),
            "event_id", "price_id", "usage_revenue",
        )
        for strategy in STRATEGIES
    }
    assert len(results["bucket"]) == 739
    assert all(found == results["bucket"] for found in results.values())
    unpriced = information.readings_without_price(
        left, information.int_meter_readings_priced(left, right)
    )
    assert unpriced.count() == 798 - 739


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_dense_intervals(spark, strategy):
    right = tariffs(
        spark, [("CT", "N", f"2026-01-02T00:00:{s:02d}", float(s)) for s in range(60)]
    )
    left = readings(spark, [(i, "CT", "N", f"2026-01-02T00:00:{i:02d}") for i in range(60)])
    found = join(left, right, strategy=strategy)
    assert rows(found, "id", "price") == sorted((str(i), str(float(i))) for i in range(60))
    if strategy == "shuffle":
        assert "SortMergeJoin" in plan(found)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_readings_long_after_the_last_price(spark, strategy):
    """The last price of a key stays in force for ever; nothing is in force before the first."""
    right = tariffs(spark, [("CT", "N", "2020-01-01T00:00:00", 1.0), ("CT", "N", "2020-06-01T00:00:00", 2.0)])
    left = readings(
        spark,
        [(1, "CT", "N", "2019-12-31T23:59:59"), (2, "CT", "N", "2020-03-01T00:00:00"),
         (3, "CT", "N", "2020-06-01T00:00:00"), (4, "CT", "N", "2055-01-01T00:00:00")],
    )
    found = {r.id: r.price for r in join(left, right, "left", strategy).collect()}
    assert found == {1: None, 2: 1.0, 3: 2.0, 4: 2.0}
    assert {r.id for r in join(left, right, "inner", strategy).collect()} == {2, 3, 4}


def test_hot_key_is_cut_by_slices(spark):
    """One key holds nearly everything; windows still run per slice and agree with brute force."""
    moments = [at(f"2025-{1 + n % 12:02d}-{1 + n % 27:02d}T{n % 24:02d}:{n % 60:02d}:00") for n in range(600)]
    frame = spark.createDataFrame(
        [("hot" if n % 50 else "cold", t, n) for n, t in enumerate(sorted(set(moments)))],
        "k string, t timestamp, n int",
    )
    data = frame.collect()
    by_key = {}
    for row in sorted(data, key=lambda r: (r.k, r.t)):
        by_key.setdefault(row.k, []).append(row)
    previous, following = {}, {}
    for members in by_key.values():
        for before, after in zip(members, members[1:], strict=False):
            previous[after.n] = before.n
            following[before.n] = after.t
    for unit in ("day", "month", None):
        found = with_previous(frame, ["k"], ["t"], F.col("n"), "p", unit)
        assert {r.n: r.p.value for r in found.collect() if r.p is not None} == previous
        found = with_next_start(frame, ["k"], "t", "f", unit)
        assert {r.n: r.f for r in found.collect() if r.f is not None} == following
        assert found.count() == len(data)


def test_carry_skips_gaps(spark):
    frame = spark.createDataFrame(
        [("a", at("2026-01-01T00:00:00"), 1), ("a", at("2026-01-05T00:00:00"), None),
         ("a", at("2026-03-01T00:00:00"), None), ("a", at("2026-03-01T01:00:00"), 4),
         ("b", at("2026-01-05T00:00:00"), None)],
        "k string, t timestamp, v int",
    )
    found = with_carried(frame, ["k"], ["t"], F.col("v"), "c", "day")
    assert [r.c for r in found.orderBy("k", "t").collect()] == [1, 1, 1, 4, None]


def test_both_branches_share_one_shuffle(spark, small):
    frame = supplied.table(spark, small, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("timestamp").alias("t"), "o_orderkey"
    )
    found = with_previous(frame, ["o_custkey"], ["t", "o_orderkey"], F.col("o_orderkey"), "p", "year")
    found.collect()
    assert "ReusedExchange" in plan(found)


def test_unknown_options(spark):
    frame = readings(spark, [(1, "CT", "N", "2026-01-01T00:00:00")])
    with pytest.raises(ValueError, match="how must be"):
        join(frame, frame, how="outer")
    with pytest.raises(ValueError, match="strategy must be"):
        join(frame, frame, strategy="hash")


@pytest.mark.parametrize("step", [1, 3, 5])
def test_dyadic_blocks_cover_intervals_of_any_length(spark, step):
    """From a microsecond to a century, before and after 1970: few blocks, none missing."""
    lengths = [1, 2, 3, 7, 1000, 999_999, 60_000_000, 3_600_000_001, 86_400_000_000, 10**14, 3 * 10**15]
    starts = [-(10**15), -1, 0, 1, 5, 1_700_000_000_123_456]
    data = [(i * 100 + j, s, s + n) for i, s in enumerate(starts) for j, n in enumerate(lengths)]
    frame = spark.createDataFrame(data, "k int, a long, b long").select(
        "k", F.timestamp_micros("a").alias("f"), F.timestamp_micros("b").alias("t"), "a", "b"
    )
    blocks = dyadic_blocks(frame, "f", "t", step)
    counts = blocks.groupBy("k").agg(F.count("*").alias("n"))
    assert counts.count() == len(data) and counts.agg(F.max("n")).first()[0] <= 2**step + 1
    size = F.expr(f"cast(power(2, {LEVEL}) as bigint)")
    assert blocks.where(F.col(BLOCK) * size >= F.col("b")).count() == 0
    assert blocks.where((F.col(BLOCK) + 1) * size <= F.col("a")).count() == 0
    edges = frame.select("k", F.col("a").alias("at")).union(frame.select("k", F.col("b") - 1))
    hit = edges.join(blocks, "k").where(F.expr(f"shiftright(at, {LEVEL}) = {BLOCK}"))
    assert hit.select("k", "at").distinct().count() == edges.distinct().count()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dyadic_equals_carry_on_random_histories(spark, how):
    draw = random.Random(4)
    starts = sorted({(k, draw.choice([0, 10**9]) + int(10 ** draw.uniform(0, 9))) for k in range(40) for _ in range(30)})
    moment = lambda n: datetime.fromtimestamp(n, UTC)
    right = spark.createDataFrame([(f"s{k}", "r", moment(n), float(n)) for k, n in starts], "state string, region string, valid_from timestamp, price double")
    right = effective_intervals(right, ["state"], "valid_from", "valid_to", "year")
    left = readings(spark, [(i, f"s{draw.randint(0, 41)}", "r", moment(draw.choice([int(10 ** draw.uniform(0, 9.4)), draw.choice(starts)[1]])).isoformat()[:19]) for i in range(3000)])
    left = left.union(left.limit(50))
    columns = ("id", "state", "moment", "price", "valid_to")
    assert rows(join(left, right, how, "dyadic"), *columns) == rows(join(left, right, how, "carry"), *columns)


def test_dyadic_moments_travel_narrow(spark, small):
    """Whole rows are joined once, by equality; only moments are carried at several levels."""
    text = plan(information.int_meter_readings_priced(supplied.readings(spark, small), effective_intervals(supplied.prices(spark, small), ["state_code"], "effective_from", "effective_to"), "dyadic"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
