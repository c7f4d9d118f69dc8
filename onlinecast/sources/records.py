"""Window records on the wire: ``x1,..,xL,y1,..,yF,topic,``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onlinecast.functions.text import stream_id
from onlinecast.sources.readings import PREFIX


def format_window_record(windows: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Text record of each window, with a trailing comma; adds ``topic`` and ``record``."""
    blocks = [F.col("x")] + ([F.col("y")] if "y" in windows.columns else [])
    numbers = [F.transform(block, lambda v: v.cast("string")) for block in blocks]
    topic = F.concat(F.lit(prefix), F.col("stream_id").cast("string"))
    return windows.withColumn("topic", topic).withColumn(
        "record", F.concat(F.concat_ws(",", *numbers, "topic"), F.lit(","))
    )


def parse_window_record(records: DataFrame, look_back: int, prefix: str = PREFIX) -> DataFrame:
    """``x``, ``y`` and ``stream_id`` of text records; a record that does not parse gets null elements."""
    fields = F.split("record", ",")
    fields = F.slice(fields, 1, F.size(fields) - 1)

    def numbers(part: Column) -> Column:
        return F.transform(part, lambda v: v.try_cast("double"))

    targets = F.slice(fields, F.lit(look_back + 1), F.greatest(F.size(fields) - look_back - 1, F.lit(0)))
    return records.select(
        *[c for c in records.columns if c not in ("stream_id", "x", "y")],
        stream_id(F.element_at(fields, -1), prefix).alias("stream_id"),
        numbers(F.slice(fields, 1, look_back)).alias("x"),
        numbers(targets).alias("y"),
    )


def read_windows(
    spark: SparkSession,
    look_back: int,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    streaming: bool = True,
    schema: str = "record string",
    prefix: str = PREFIX,
) -> DataFrame:
    """Parsed window records; a Kafka stream starts at the latest offset unless ``options`` say otherwise."""
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if fmt == "kafka":
        options = ({"startingOffsets": "latest"} if streaming else {}) | options
        raw = reader.format("kafka").options(**options).load()
        raw = raw.select(F.col("value").cast("string").alias("record"), F.col("timestamp").alias("t_end"))
    else:
        raw = reader.format(fmt).options(**options).schema(schema).load()
    return parse_window_record(raw, look_back, prefix)


def write_windows(
    windows: DataFrame,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    checkpoint: str | None = None,
    prefix: str = PREFIX,
    trigger: dict | None = None,
    topics: Column | None = None,
) -> StreamingQuery | None:
    """Write window records to Kafka or a file table; a streaming frame returns its query.

    ``topics`` names the topic of each window, for example one for each model and mode; files are then parted by it.
    Without it the options name the one topic. The source's ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger`` bounds what is in flight.
    """
    named = windows if topics is None else windows.withColumn("__to", topics)
    records = format_window_record(named, prefix)
    to = [] if topics is None else [F.col("__to").alias("topic" if fmt == "kafka" else "window_topic")]
    options = dict(options or {})
    if fmt == "kafka":
        records = records.select(F.col("topic").alias("key"), F.col("record").alias("value"), *to)
        options = {"kafka.acks": "all"} | options
    else:
        records = records.select("t_end", "record", *to)
    parted = ["window_topic"] if to and fmt != "kafka" else []
    if not windows.isStreaming:
        records.write.format(fmt).options(**options).partitionBy(*parted).mode("append").save()
        return None
    writer = records.writeStream.format(fmt).partitionBy(*parted).options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
