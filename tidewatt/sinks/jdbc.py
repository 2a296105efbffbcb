"""Append to a staging table of an external database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class JdbcStaging:
    """Spark writes each partition in batches; the database merges from the staging table.

    ``partitions`` bounds the number of connections.
    """

    url: str
    table: str
    user: str
    password: str
    batch_size: int = 1_000
    statement_timeout_seconds: int = 300
    partitions: int = 16

    def __post_init__(self) -> None:
        if self.batch_size < 1:
            raise ValueError("a batch holds one row at least")

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "batchsize": str(self.batch_size),
            "queryTimeout": str(self.statement_timeout_seconds),
            "numPartitions": str(self.partitions),
        }

    def write(self, frame: DataFrame, mode: str = "append") -> None:
        frame.write.format("jdbc").options(**self.options()).mode(mode).save()
