"""Append-only model registry ``(model_id, version, update_time, loss, params)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.functions.vectors import squared_distance
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, over_frame, with_position

FIRST_LOSS = 100.0
STATES = ["deploy", "pause"]


def next_versions(latest: DataFrame, updates: DataFrame, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """``updates`` with the versions that follow ``latest(model_id, latest)``, by ``batch_id`` if any, time and loss."""
    order = [c for c in ("batch_id", "update_time", "loss") if c in updates.columns]
    numbered = with_position(updates, ["model_id"], order, "__at", group_rows)
    numbered = attach(numbered, latest, ["model_id"], "left")
    version = F.coalesce("latest", F.lit(0)) + F.col("__at") + 1
    return numbered.withColumn("version", version).drop("latest", "__at")


def publish(registry: DataFrame, updates: DataFrame, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Registry with ``updates(model_id, update_time, loss, params)`` appended as the next versions."""
    latest = registry.groupBy("model_id").agg(F.max("version").alias("latest"))
    return registry.unionByName(next_versions(latest, updates, group_rows).select(registry.columns))


def current_models(registry: DataFrame) -> DataFrame:
    """Newest version of each model and how often it was pushed."""
    rest = [c for c in registry.columns if c not in ("model_id", "version")]
    return (
        registry.groupBy("model_id")
        .agg(
            F.max("version").alias("version"),
            F.max_by(F.struct(*rest), "version").alias("__newest"),
            F.count(F.lit(1)).alias("num_push"),
        )
        .select("model_id", "version", "num_push", *[F.col(f"__newest.{c}").alias(c) for c in rest])
    )


def weight_change(registry: DataFrame, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Squared distance of each version's parameters to the version before; ``changed`` if above 0."""
    lagged = over_frame(
        registry,
        ["model_id"],
        ["version"],
        before=1,
        after=0,
        columns={"__previous": lambda w: F.lag("params").over(w)},
        group_rows=group_rows,
    )
    distance = squared_distance("params", "__previous")
    return (
        lagged.withColumn("distance", distance)
        .withColumn("changed", F.coalesce(F.col("distance") > 0, F.lit(False)))
        .drop("__previous")
    )


def list_models(models: DataFrame, registry: DataFrame) -> DataFrame:
    """Deployed models with their streams, times to the minute and registry loss."""
    current = current_models(registry).select("model_id", "update_time", "loss")
    minute = "yyyy-MM-dd HH:mm"
    return attach(models, current, ["model_id"], "left").select(
        "name",
        F.concat_ws(",", "streams").alias("streams"),
        F.col("online").alias("train"),
        F.date_format("create_time", minute).alias("deployed_at"),
        F.date_format(F.coalesce("update_time", "create_time"), minute).alias("updated_at"),
        F.coalesce("loss", F.lit(FIRST_LOSS)).alias("loss"),
    )


def count_by_state(models: DataFrame, states: list[str] = STATES) -> DataFrame:
    """Number of models in each state, 0 for states without one."""
    counts = models.groupBy().agg(*[F.count_if(F.col("state") == s).alias(s) for s in states])
    return counts.select(
        F.explode(F.create_map(*[part for s in states for part in (F.lit(s), F.col(s))])).alias("state", "models")
    )
