"""Catalog of streams and small projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onlinecast.plans.joins import attach


def stream_catalog(readings: DataFrame, prefix: str) -> DataFrame:
    """Topics that start with ``prefix``, split into namespace and name, with their extent."""
    parts = F.split("topic", "\\.", 2)
    return (
        readings.where(F.col("topic").startswith(prefix))
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("readings"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn("namespace", F.get(parts, F.lit(0)))
        .withColumn("name", F.get(parts, F.lit(1)))
    )


def observed_value(x: str = "x") -> Column:
    """The newest value of a window."""
    return F.element_at(x, -1)


def results_for_model(results: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Documents whose stream belongs to their model, and all update markers."""
    pairs = subscriptions.select("model_id", "stream_id").distinct()
    marked = attach(results, pairs.withColumn("__own", F.lit(True)), ["model_id", "stream_id"], "left")
    return marked.where(F.col("__own") | F.col("stream_id").isNull()).select(results.columns)
