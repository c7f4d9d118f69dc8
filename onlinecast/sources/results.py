"""Result documents at rest, by micro-batch and bucket of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = (
    "model_id long, seq long, batch_id long, stream_id int, pred array<double>, true array<double>, "
    "ts timestamp, loss double, average_loss double, updated_at timestamp, part long"
)
STORED = SCHEMA + ", run long, bucket int"
BUCKETS = 64


def _conform(results: DataFrame) -> DataFrame:
    """All result columns; the ones a writer does not fill are null."""
    known = set(results.columns)
    return results.select(
        *[
            (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(SCHEMA)
        ]
    )


def _clustered(results: DataFrame) -> DataFrame:
    """Documents by bucket of models, in files of even size and sorted by model."""
    bucketed = _conform(results).withColumn("bucket", F.pmod(F.col("model_id"), F.lit(BUCKETS)).cast("int"))
    return bucketed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "model_id", "seq")


def write_results(results: DataFrame, path: str, restart: bool = False) -> None:
    """Write documents; ``restart`` empties the table first."""
    table = _clustered(results).withColumn("run", F.lit(-1).cast("long"))
    table.write.mode("overwrite" if restart else "append").partitionBy("run", "bucket").parquet(path)


def append_results(results: DataFrame, path: str, run: int) -> None:
    """Write the documents of micro-batch ``run``; a replay replaces what the first try left."""
    _clustered(results).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/run={run}")


def read_results(spark: SparkSession, path: str, model_id: int | None = None) -> DataFrame:
    """Documents of one model (only its bucket is read, and of it the files that hold the model) or of all."""
    table = spark.read.schema(STORED).parquet(path)
    if model_id is not None:
        table = table.where((F.col("bucket") == model_id % BUCKETS) & (F.col("model_id") == model_id))
    return table.drop("run", "bucket", "shape")


def stream_results(spark: SparkSession, path: str) -> DataFrame:
    """Documents as they are written; those of a repeated micro-batch of their writer come again."""
    return spark.readStream.schema(STORED).parquet(path).drop("run", "bucket")
