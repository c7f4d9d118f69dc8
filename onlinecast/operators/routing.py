"""Which models read which streams, and which registry version they use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.functions.text import stream_id
from onlinecast.operators.registry import current_models
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, running

SHAPE = ["look_back", "shift", "forward_step", "forward_size"]


def subscriptions(models: DataFrame, prefix: str = "ami") -> DataFrame:
    """One row per model, stream and mode: every model infers, online models also train."""
    modes = F.when(F.col("online"), F.array(F.lit("infer"), F.lit("train"))).otherwise(F.array(F.lit("infer")))
    forward = {
        c: F.when(F.col("mode") == "train", F.col(c)) for c in ("forward_step", "forward_size")
    }
    return (
        models.withColumn("stream", F.explode("streams"))
        .withColumn("mode", F.explode(modes))
        .withColumns(forward)
        .select("model_id", stream_id("stream", prefix).alias("stream_id"), "mode", *SHAPE)
    )


def subscribe(readings: DataFrame, subs: DataFrame) -> DataFrame:
    """Readings of each subscription; a reading goes to every model that subscribes its stream."""
    return attach(readings, subs, ["stream_id"])


def merge_streams(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, batch or streaming."""
    return reduce(DataFrame.unionByName, frames)


def asof_model(batches: DataFrame, registry: DataFrame, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Add to each batch (``model_id, batch_id, ts``) the newest registry version at its time, null if none."""
    at_batch = batches.withColumns({"__side": F.lit(1), "__entry": F.lit(None).cast("long")})
    at_entry = registry.select(
        "model_id", F.col("update_time").alias("ts"), F.lit(0).alias("__side"), F.col("version").alias("__entry")
    )
    both = at_batch.unionByName(at_entry, allowMissingColumns=True)
    both = both.withColumn("__tie", F.coalesce("__entry", "batch_id"))
    order = ["ts", "__side", "__tie"]
    dated = running(both, ["model_id"], order, "__entry", "last", "version", group_rows=group_rows)
    return dated.where(F.col("__side") == 1).drop("__side", "__entry", "__tie")


def loss_gated_lookup(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Answer requests ``(model_id, loss)``: a model is handed out unless the request's loss is already lower.

    ``status`` is ``found``, ``refused`` or ``unknown``; the model's version is null unless found.
    """
    current = current_models(registry).select(
        "model_id", F.col("version").alias("__version"), F.col("loss").alias("model_loss")
    )
    answered = attach(requests, current, ["model_id"], "left")
    unknown = F.col("__version").isNull()
    status = F.when(unknown, "unknown").when(F.col("loss") < F.col("model_loss"), "refused").otherwise("found")
    return (
        answered.withColumn("status", status)
        .withColumn("version", F.when(F.col("status") == "found", F.col("__version")))
        .drop("__version")
    )


def reject_duplicates(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Mark deploy requests ``(request_id, name, ..)``: taken names are refused, else the first request wins."""
    taken = models.select("name").distinct()
    first = requests.groupBy("name").agg(F.min("request_id").alias("request_id"))
    winners = first.join(taken, "name", "left_anti").withColumn("accepted", F.lit(True))
    marked = attach(requests, winners, ["name", "request_id"], "left")
    return marked.withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def withdraw(models: DataFrame, names: DataFrame) -> DataFrame:
    """Models that remain after the named ones are taken down."""
    return attach(models, names.select("name").distinct(), ["name"], "left_anti")


def withdraw_status(models: DataFrame, names: DataFrame) -> DataFrame:
    """For each requested name, whether a model was taken down."""
    known = models.select("name").distinct().withColumn("status", F.lit(True))
    return attach(names, known, ["name"], "left").withColumn("status", F.coalesce("status", F.lit(False)))
