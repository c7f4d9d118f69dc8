"""Axis maxima of the results of a job, kept up to date while it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onlinecast.operators.analytics import maxima
from onlinecast.plans.tables import VersionedTable
from onlinecast.sources.results import stream_results
from onlinecast.streaming.state import JobPaths

SUMMARY = "model_id long, documents long, new_documents long, max_value double, max_loss double, max_average_loss double"


def _table(spark: SparkSession, paths: JobPaths) -> VersionedTable:
    return paths.table(spark, "summary", SUMMARY, ["model_id"])


def summary_job(spark: SparkSession, paths: JobPaths, trigger: dict | None = None) -> StreamingQuery:
    """Fold the documents at ``paths.results`` into a row for each model as they arrive.

    The state is that row: maxima, and the largest document number, which tells how many there are since numbers are
    dense. Neither changes if a document comes twice, as after a repeated micro-batch of the job that writes
    them. ``new_documents`` are those since the row was written before.
    """
    table = _table(spark, paths)
    totals = stream_results(spark, paths.results).groupBy("model_id").agg((F.max("seq") + 1).alias("documents"), *maxima())

    def store(changed: DataFrame, batch_id: int) -> None:
        before = table.read(batch_id).select("model_id", F.col("documents").alias("__known"))
        new = F.col("documents") - F.coalesce("__known", F.lit(0))
        table.write(changed.join(before, "model_id", "left").withColumn("new_documents", new), batch_id)

    writer = totals.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", paths.checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def read_summary(spark: SparkSession, paths: JobPaths) -> DataFrame:
    """The newest row of each model."""
    return _table(spark, paths).read()
