"""Time the headline queries and print one JSON line.

Every query runs once to warm up, then BENCH_RUNS times into a sink that discards rows; the
median counts. ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatt.registry.queries import published  # noqa: E402
from tidewatt.session import session  # noqa: E402

HEADLINE = (
    "validate_reason_counts",
    "dedupe_first",
    "merge_insert_only",
    "merge_upsert",
    "effective_intervals",
    "asof_priced",
    "asof_priced_shuffle",
    "asof_priced_carry",
    "asof_after_last",
    "asof_priced_dyadic",
    "asof_dyadic",
    "hub_meter",
    "link_meter_reading",
    "sat_reading_metrics",
    "sat_history",
    "pit_history",
    "int_readings",
    "int_priced",
    "fact_hourly_billing",
    "mart_operations",
    "mart_billing",
    "mart_billing_shipped",
    "metric_daily_meter_kpis",
    "metric_daily_regional_billing",
    "chart_top_meters",
    "check_rows",
    "check_combo",
    "chart_billing_trend_hour",
    "check_vault",
    "distinct_meters_grains",
    "stream_hourly",
    "stream_priced",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        # A local master only: intermediate tables of one run, in a folder of its own.
        "spark.checkpoint.dir": os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="bench-"),
    }
    spark = session("tidewatt-bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    registered = published()
    timings = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        samples = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            frame = registered[name](spark, folder)
            frame.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(samples[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "settings": settings,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
