"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "134217728",
}


def session(
    name: str = "tidewatt", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    Shuffle parallelism is left to the cluster unless given in ``settings``.
    """
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate files, visible to every executor.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local master, where driver
    and executors share one disk, may fall back to a temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        parent = tempfile.mkdtemp(prefix="tidewatt-")
    return f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
