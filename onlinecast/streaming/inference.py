"""Continuous scoring of every model, with the newest published parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onlinecast.functions.vectors import squared_distance
from onlinecast.operators.batching import ARRIVAL, PER_TICK, numbered_batch
from onlinecast.operators.models import ModelSpec
from onlinecast.operators.registry import current_models
from onlinecast.operators.scoring import one_step_errors, result_documents, rolling_loss, score
from onlinecast.operators.windows import TAIL_SCHEMA, WindowShape, continued_windows
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import top_rows, with_position
from onlinecast.plans.tables import written
from onlinecast.sources.registry import read_registry
from onlinecast.sources.results import append_results
from onlinecast.streaming.state import JobPaths, run_batches

PER_BATCH = PER_TICK
PAIR = ["model_id", "stream_id"]
SCORED = "model_id long, stream_id int, k long, t_end timestamp, true double, pred array<double>, batch_id long, pos int"
LOSSES = "model_id long, stream_id int, batch_id long, loss double"


def inference_job(
    readings: DataFrame,
    subscriptions: DataFrame,
    spec: ModelSpec,
    shape: WindowShape,
    paths: JobPaths,
    batch_size: int = 3,
    losses_kept: int = 3,
    scope: str = "stream",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window, score and evaluate arriving readings; documents go to the results table.

    One query serves all models that share ``spec`` and ``shape``; ``subscriptions(model_id, stream_id)`` says
    who reads what. Each micro-batch uses the parameters that are newest when it starts, and notes in
    the results, at the time of its newest reading, when they differ from those before. Last predictions and losses live in state tables by
    micro-batch, so a replayed micro-batch writes the same documents.
    """
    spark = readings.sparkSession
    tails = paths.table(spark, "tails", TAIL_SCHEMA, ["stream_id"])
    used = paths.table(spark, "models", "model_id long, model_version long, params array<double>", ["model_id"])
    carry = {"stream": PAIR, "model": ["model_id"]}[scope]
    newest_first = [F.desc("batch_id"), F.desc("stream_id")]
    last_scored = paths.table(spark, "scored", SCORED, carry)
    last_losses = paths.table(spark, "losses", LOSSES, carry)
    counts = paths.table(spark, "counts", "model_id long, documents long", ["model_id"])
    pairs = subscriptions.select(*PAIR).distinct()

    def step(batch: DataFrame, batch_id: int) -> None:
        earlier_models = used.read(batch_id)
        if not used.has(batch_id):
            newest = current_models(read_registry(spark, paths.registry))
            newest = newest.withColumnRenamed("version", "model_version")
            known = earlier_models.select("model_id", "model_version")
            used.write(newest.join(known, ["model_id", "model_version"], "left_anti"), batch_id)
        models = used.read(batch_id + 1)

        windows, tail = continued_windows(batch, tails.read(batch_id), shape)
        tails.write(tail, batch_id)
        rows = score(attach(windows, pairs, ["stream_id"]), models.select("model_id", "params"), spec).drop("x")
        placed = with_position(rows, ["model_id"], ARRIVAL, "__at")
        placed = (
            placed.withColumn("batch_id", numbered_batch(F.lit(batch_id).cast("long"), F.floor(F.col("__at") / batch_size)))
            .withColumn("pos", (F.col("__at") % batch_size).cast("int"))
            .drop("__at")
        )
        scored = written(placed, "scored")

        carried = last_scored.read(batch_id)
        errors = one_step_errors(carried.unionByName(scored), scope).where(F.col("batch_id") >= batch_id * PER_BATCH)
        last_scored.write(top_rows(scored, carry, [*newest_first, F.desc("pos")], 1), batch_id)

        documents = written(result_documents(errors), "documents")
        held = last_losses.read(batch_id)
        rolled = rolling_loss(
            held.unionByName(documents.select(*held.columns)), losses_kept, scope
        ).where(F.col("batch_id") >= batch_id * PER_BATCH)
        documents = documents.join(rolled.drop("loss"), ["model_id", "stream_id", "batch_id"])
        known = held.unionByName(documents.select(*held.columns)).where(F.col("loss").isNotNull())
        touched = attach(known, documents.select(*carry).distinct(), carry, "left_semi")
        last_losses.write(top_rows(touched, carry, newest_first, losses_kept - 1), batch_id)

        before = earlier_models.select("model_id", F.col("params").alias("__before"))
        swapped = models.join(before, "model_id").where(squared_distance("params", "__before") > 0)
        markers = swapped.select(
            "model_id",
            F.lit(batch_id * PER_BATCH - 1).alias("batch_id"),
            F.lit(None).cast("int").alias("stream_id"),
            F.lit(batch.agg(F.max("ts")).first()[0]).cast("timestamp").alias("updated_at"),
        )
        numbered = with_position(
            documents.unionByName(markers, allowMissingColumns=True), ["model_id"], ["batch_id", "stream_id"], "__at"
        )
        base = counts.read(batch_id)
        numbered = attach(numbered, base, ["model_id"], "left")
        numbered = numbered.withColumn("seq", F.coalesce("documents", F.lit(0)) + F.col("__at"))
        numbered = written(numbered.drop("__at", "documents"), "numbered")
        counts.write(numbered.groupBy("model_id").agg((F.max("seq") + 1).alias("documents")), batch_id)
        append_results(numbered, paths.results, batch_id)

    return run_batches(readings, step, paths, trigger)


def inference_jobs(
    readings: DataFrame,
    subscriptions: DataFrame,
    model: Callable[[int], ModelSpec],
    paths: JobPaths,
    **options,
) -> list[StreamingQuery]:
    """One ``inference_job`` for each window shape in ``subscriptions(model_id, stream_id, look_back, shift)``.

    ``model`` gives the spec for a look-back. Jobs share the registry; state, checkpoint and results of a shape are
    in a folder of its own, and ``read_results(spark, paths.results)`` reads the documents of all.
    """
    shapes = sorted(map(tuple, subscriptions.select("look_back", "shift").distinct().collect()))
    queries = []
    for look_back, shift in shapes:
        members = subscriptions.where((F.col("look_back") == look_back) & (F.col("shift") == shift))
        own = paths.below(f"shape={look_back}x{shift}")
        queries.append(inference_job(readings, members, model(look_back), WindowShape(look_back, shift), own, **options))
    return queries
