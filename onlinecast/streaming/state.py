"""Names and tables of a job: where it reads, writes and keeps its state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from onlinecast.plans.tables import VersionedTable, passing_tables


@dataclass(frozen=True)
class JobPaths:
    """``state`` and ``checkpoint`` belong to one job; ``registry`` is shared; ``results`` is its output."""

    state: str
    checkpoint: str
    registry: str
    results: str

    @property
    def job(self) -> str:
        """Name under which the job publishes; a new checkpoint is a new job."""
        return md5(self.checkpoint.encode()).hexdigest()[:16]

    def below(self, name: str) -> JobPaths:
        """Folders of a part of the work, which shares the registry."""
        return JobPaths(f"{self.state}/{name}", f"{self.checkpoint}/{name}", self.registry, f"{self.results}/{name}")

    def table(self, spark: SparkSession, name: str, schema: str, keys: list[str], compact: int = 20) -> VersionedTable:
        return VersionedTable(spark, f"{self.state}/{name}", schema, keys, compact)


def run_batches(
    readings: DataFrame, step: Callable[[DataFrame, int], None], paths: JobPaths, trigger: dict | None
) -> StreamingQuery:
    """Start ``step`` on every non-empty micro-batch; tables it writes on its way are deleted after it."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                with passing_tables(batch.sparkSession):
                    step(batch, batch_id)
        finally:
            batch.unpersist()

    writer = readings.writeStream.foreachBatch(guarded).option("checkpointLocation", paths.checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
