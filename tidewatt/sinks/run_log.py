"""One JSON row per job run."""

from __future__ import annotations

import json
import logging
from datetime import datetime

from pyspark.sql import SparkSession

EVENT = "job_summary"
logger = logging.getLogger("tidewatt.run")


def emit_summary(
    spark: SparkSession,
    path: str | None,
    *,
    job: str,
    run_id: str,
    started_at: datetime,
    finished_at: datetime,
    **counters: object,
) -> dict[str, object]:
    """Log the summary and append it to the run log when one is configured."""
    summary = {
        "event": EVENT,
        "job": job,
        "run_id": run_id,
        "timestamp": finished_at.isoformat(),
        "duration_seconds": round((finished_at - started_at).total_seconds(), 3),
        **counters,
    }
    text = json.dumps(summary, default=str, sort_keys=True)
    logger.info(text)
    if path is not None:
        spark.createDataFrame([(text,)], "value string").write.mode("append").text(path)
    return summary
