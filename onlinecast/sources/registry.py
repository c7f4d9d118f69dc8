"""The registry at rest: every publication is a folder of its job and run, so a replayed one replaces itself alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onlinecast.operators.registry import FIRST_LOSS, next_versions
from onlinecast.plans.tables import empty, exists

COLUMNS = "model_id long, version long, update_time timestamp, loss double, params array<double>"
SCHEMA = COLUMNS + ", job string, run long"
DEPLOYED = "deploy"


def _publications(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if exists(spark, path) else empty(spark, SCHEMA)


def deploy(models: DataFrame, path: str) -> None:
    """Store version 1 of those of ``models(model_id, create_time, params)`` that the registry does not have yet."""
    known = _publications(models.sparkSession, path).where(F.col("job") == DEPLOYED).select("model_id")
    first = models.join(known, "model_id", "left_anti").select(
        "model_id",
        F.lit(1).cast("long").alias("version"),
        F.col("create_time").alias("update_time"),
        F.lit(FIRST_LOSS).alias("loss"),
        "params",
    )
    first.write.mode("append").parquet(f"{path}/job={DEPLOYED}/run=0")


def read_deployed(spark: SparkSession, path: str) -> DataFrame:
    """The versions that were deployed, without what was published since."""
    return _publications(spark, path).where(F.col("job") == DEPLOYED).drop("job", "run")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all jobs."""
    return _publications(spark, path).drop("job", "run")


def append_registry(updates: DataFrame, path: str, run: int, job: str) -> None:
    """Publish ``updates(model_id, update_time, loss, params)`` as run ``run`` of ``job``.

    Versions go on from the newest one of each model, what this job stored for this or later runs aside. Only the
    new rows are written. One job at a time may publish versions of a model.
    """
    stored = _publications(updates.sparkSession, path)
    known = stored.where((F.col("job") != job) | (F.col("run") < run))
    latest = known.groupBy("model_id").agg(F.max("version").alias("latest"))
    new = next_versions(latest, updates).select("model_id", "version", "update_time", "loss", "params")
    new.write.mode("overwrite").parquet(f"{path}/job={job}/run={run}")
