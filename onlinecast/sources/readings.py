"""Raw readings: one payload per message, one topic per stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onlinecast.functions.text import decode_number, stream_id

PREFIX = "sensor.ami"


def read_readings(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    streaming: bool = False,
    schema: str | None = None,
    prefix: str = PREFIX,
) -> DataFrame:
    """Readings as ``topic, stream_id, ts, event_id, payload``, oldest first to be read.

    Kafka subscribes to every topic of ``prefix`` and starts at the earliest offset unless ``options`` say
    otherwise. Other formats must hold the columns ``topic, ts, event_id, payload``.
    """
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if fmt == "kafka":
        pattern = prefix.replace(".", "\\.") + ".*"
        options = {"subscribePattern": pattern, "startingOffsets": "earliest"} | options
        raw = reader.format("kafka").options(**options).load()
        raw = raw.select(
            "topic", F.col("timestamp").alias("ts"), F.col("offset").alias("event_id"), F.col("value").alias("payload")
        )
    else:
        reader = reader.format(fmt).options(**options)
        raw = (reader.schema(schema) if schema else reader).load()
    return raw.select("topic", stream_id("topic", prefix).alias("stream_id"), "ts", "event_id", "payload")


def decode_readings(raw: DataFrame) -> DataFrame:
    """Readings with a numeric ``value`` and a numeric stream id."""
    decoded = raw.withColumn("value", decode_number("payload"))
    return decoded.where(F.col("value").isNotNull() & F.col("stream_id").isNotNull()).drop("payload")


def rejected_readings(raw: DataFrame) -> DataFrame:
    """The messages ``decode_readings`` leaves out, with the reason."""
    no_stream = F.col("stream_id").isNull()
    reason = F.when(no_stream, "topic").when(decode_number("payload").isNull(), "payload")
    return raw.withColumn("reason", reason).where(F.col("reason").isNotNull())
