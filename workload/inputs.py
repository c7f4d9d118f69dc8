"""Operator inputs derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onlinecast.operators.analytics import number_results
from onlinecast.operators.batching import adaptive_batches, fixed_batches
from onlinecast.operators.models import linear_model
from onlinecast.operators.registry import weight_change
from onlinecast.operators.routing import subscriptions
from onlinecast.operators.scoring import one_step_errors, result_documents, rolling_loss, score
from onlinecast.operators.windows import lookback_windows, training_windows
from onlinecast.plans.tables import new_path
from onlinecast.sources import decode_readings, read_readings
from onlinecast.sources.readings import PREFIX
from onlinecast.sources.registry import deploy
from onlinecast.streaming.state import JobPaths

MODELS = 10
TICK = 21600
HOUR = 3600
INFERENCE = linear_model(3)
TRAINING = linear_model(2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = F.col("user_id").cast("int")
    return table(spark, sf_dir, "events").select(
        stream.alias("stream_id"),
        F.concat(F.lit(PREFIX), stream.cast("string")).alias("topic"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        "value",
    )


def line_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities sold by each supplier, in shipping order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("stream_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.col("l_quantity").alias("value"),
    )


def messages(spark: SparkSession, sf_dir: str, dirty: bool = False) -> str:
    """Folder of raw messages; with ``dirty``, error events carry text that is not a number."""
    payload = F.col("value").cast("string")
    if dirty:
        payload = F.when(F.col("event_type") == "error", F.col("props")).otherwise(payload)
    path = new_path(spark, "messages")
    table(spark, sf_dir, "events").select(
        F.concat(F.lit(PREFIX), F.col("user_id").cast("string")).alias("topic"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.encode(payload, "UTF-8").alias("payload"),
    ).write.parquet(path)
    return path


SLICES = 3


def replay(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery | list[StreamingQuery]]) -> None:
    """Deliver the messages in three slices of equal time; after each, run the query on what is new."""
    events = table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    first, last = events.agg(F.min("at"), F.max("at")).first()
    part = F.floor((F.col("at") - first) * SLICES / (last - first + 1))
    path = new_path(spark, "messages")
    for i in range(SLICES):
        events.where(part == i).select(
            F.concat(F.lit(PREFIX), F.col("user_id").cast("string")).alias("topic"),
            F.col("ts").cast("timestamp").alias("ts"),
            "event_id",
            F.encode(F.col("value").cast("string"), "UTF-8").alias("payload"),
        ).write.mode("append").parquet(path)
        raw = read_readings(spark, "parquet", {"path": path}, streaming=True, schema=MESSAGE_SCHEMA)
        started = start(decode_readings(raw))
        for query in started if isinstance(started, list) else [started]:
            query.awaitTermination()


def job_paths(spark: SparkSession, name: str) -> JobPaths:
    root = new_path(spark, name)
    return JobPaths(f"{root}/state", f"{root}/checkpoint", f"{root}/registry", f"{root}/results")


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_of(readings(spark, sf_dir).select("stream_id").distinct())


def deployed(spark: SparkSession, sf_dir: str, params: list[float], paths: JobPaths) -> None:
    """Deploy the ten models with ``params``."""
    found = memberships(spark, sf_dir).select("model_id").distinct()
    created = F.timestamp_seconds(F.lit(1704067200))
    rows = found.select("model_id", created.alias("create_time"), F.array(*[F.lit(p) for p in params]).alias("params"))
    deploy(rows, paths.registry)


MESSAGE_SCHEMA = "topic string, ts timestamp, event_id long, payload binary"


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per supplier on three neighbouring streams."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        s.alias("model_id"),
        F.col("s_name").alias("name"),
        F.array(*[F.concat(F.lit("ami"), (s + i).cast("string")) for i in range(3)]).alias("streams"),
        (2 + s % 3).cast("int").alias("look_back"),
        (1 + s % 2).cast("int").alias("shift"),
        (1 + s % 2).cast("int").alias("forward_step"),
        (1 + s % 4).cast("int").alias("forward_size"),
        (s % 3 != 0).alias("online"),
        F.when(s % 5 == 0, "pause").otherwise("deploy").alias("state"),
        F.timestamp_seconds(F.lit(1704067200) + s * 3600).alias("create_time"),
    )


def subscribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscriptions(models(spark, sf_dir))


def model_of(df: DataFrame) -> DataFrame:
    """Every stream belongs to one of ten models."""
    return df.withColumn("model_id", (F.col("stream_id") % MODELS).cast("long"))


def inference_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_of(lookback_windows(readings(spark, sf_dir), 3))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score(inference_windows(spark, sf_dir), list(INFERENCE.init), INFERENCE)
    return adaptive_batches(rows.drop("x"), 3, TICK)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_loss(result_documents(one_step_errors(scored(spark, sf_dir))))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version per event; the parameters change only with the fifties of its value."""
    events = table(spark, sf_dir, "events")
    model = (F.col("user_id") % MODELS).alias("model_id")
    order = Window.partitionBy("model_id").orderBy("update_time", "event_id")
    third = F.lit(1 / 3)
    return (
        events.select(
            model,
            F.col("ts").cast("timestamp").alias("update_time"),
            "event_id",
            F.col("value").alias("loss"),
            F.array(third, third, third, F.floor(F.col("value") / 50) / 10).alias("params"),
        )
        .withColumn("version", F.row_number().over(order).cast("long"))
        .select("model_id", "version", "update_time", "loss", "params")
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and model updates, numbered per model."""
    tick = F.floor(F.unix_seconds("update_time") / TICK)
    updates = (
        weight_change(registry(spark, sf_dir))
        .where("changed")
        .select(
            "model_id",
            (tick * (1 << 31) + ((1 << 31) - 1)).alias("batch_id"),
            F.lit(None).cast("int").alias("stream_id"),
            F.col("update_time").alias("updated_at"),
        )
    )
    return number_results(documents(spark, sf_dir).unionByName(updates, allowMissingColumns=True))


def learning_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = readings(spark, sf_dir).withColumn("value", F.col("value") / 100)
    return model_of(training_windows(scaled, 2))


def learning_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_batches(learning_windows(spark, sf_dir), 30, keep_tail=True)


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The starting parameters of the ten models."""
    start = F.array(F.lit(0.5), F.lit(0.25), F.lit(0.1))
    return memberships(spark, sf_dir).select("model_id").distinct().withColumn("params", start)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as windows of one model, a stream per label."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit(0).cast("long").alias("model_id"),
        F.col("label").alias("stream_id"),
        F.col("vec_id").alias("k"),
        F.timestamp_seconds("vec_id").alias("t_end"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.array(F.lit(0.0)).alias("y"),
    )


def training_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training batch per event: its loss is the value, its size is between 1 and 50 rows."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % MODELS).alias("model_id"),
        F.col("event_id").alias("batch_id"),
        (1 + F.col("event_id") % 50).alias("rows"),
        F.col("value").alias("loss"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings of training runs, taken from order lines."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % MODELS).alias("model_id"),
        F.col("l_quantity").alias("work"),
        (20 * F.col("l_quantity") + 100 * F.col("l_tax") + F.col("l_linenumber")).alias("seconds"),
    )
