"""Episodic memory: a bounded set of past training windows per (model, stream).

Memory and windows share the columns ``model_id, stream_id, k, t_end, x, y``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.functions.vectors import cosine_to_ones
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, running, top_rows
from onlinecast.plans.tables import written

STREAM = ["model_id", "stream_id"]
COLUMNS = [*STREAM, "k", "t_end", "x", "y"]


def ring_memory(
    memory: DataFrame | None, windows: DataFrame, capacity: int, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """The newest ``capacity`` windows of each stream."""
    rows = windows.select(*COLUMNS)
    if memory is not None:
        rows = memory.select(*COLUMNS).unionByName(rows)
    return top_rows(rows, STREAM, [F.desc("t_end"), F.desc("k")], capacity, group_rows)


def ring_memory_reset(batches: DataFrame, capacity: int, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """What a ring shows whose fill count restarts at 0 as soon as it is full.

    ``batches`` are windows with ``batch_id``. Visible are the windows of the batches after the last one
    that filled the ring; none if the last batch did.
    """
    last = _last_fill(batches.groupBy(*STREAM, "batch_id").agg(F.count(F.lit(1)).alias("size")), capacity, group_rows)
    kept = attach(batches, last, STREAM, "left")
    return kept.where(F.col("__full").isNull() | (F.col("batch_id") > F.col("__full"))).select(*COLUMNS)


def _last_fill(sizes: DataFrame, capacity: int, group_rows: int | None) -> DataFrame:
    """The last batch of each stream that fills the ring, for streams that have one.

    A ring that is empty behind some batch is next full at the first batch where the running sum of sizes is larger by
    ``capacity``: every batch has a jump to another one. The last fill is where the jumps from the start end. Jumps are doubled until
    those of the start go no further, so n fills take log n rounds.
    """
    summed = running(sizes, STREAM, ["batch_id"], "size", "sum", "__sum", group_rows=group_rows)
    summed = written(summed.select(*STREAM, "batch_id", "__sum"), "sums")
    nobody = F.lit(None).cast(sizes.schema["batch_id"].dataType)
    sources = summed.unionByName(summed.select(*STREAM).distinct().withColumns({"batch_id": nobody, "__sum": F.lit(0).cast("long")}))
    # downwards over the sums, the last batch seen is the first one that reaches the sum asked for
    reached = summed.select(*STREAM, (-F.col("__sum")).alias("__down"), F.lit(0).alias("__asks"), F.col("batch_id").alias("__to"), nobody.alias("batch_id"))
    asked = sources.select(*STREAM, (-F.col("__sum") - capacity).alias("__down"), F.lit(1).alias("__asks"), nobody.alias("__to"), "batch_id")
    found = running(
        reached.unionByName(asked), STREAM, ["__down", "__asks", "__to", "batch_id"], "__to", "last", "__next", group_rows=group_rows
    )
    jumps = found.where((F.col("__asks") == 1) & F.col("__next").isNotNull()).select(*STREAM, "batch_id", "__next")
    jumps = written(jumps, "jumps")
    while True:
        further = jumps.where("batch_id is not null").select(*STREAM, F.col("batch_id").alias("__next"), F.col("__next").alias("__then"))
        starts = jumps.where("batch_id is null")
        if starts.join(further, [*STREAM, "__next"], "left_semi").isEmpty():
            return starts.select(*STREAM, F.col("__next").alias("__full"))
        doubled = jumps.join(further, [*STREAM, "__next"], "left")
        jumps = written(doubled.select(*STREAM, "batch_id", F.coalesce("__then", "__next").alias("__next")), "jumps")


def similarity_memory(
    memory: DataFrame | None, windows: DataFrame, capacity: int, seed: int | None = 0
) -> DataFrame:
    """At most ``capacity`` windows per stream, spread over their cosine similarity to the ones vector.

    Kept are the first least similar and the first most similar window, and one from each inner bin of
    ``capacity`` equal bins between them, drawn by a seeded hash (the oldest one if ``seed`` is None).
    """
    if capacity < 2:
        raise ValueError("similarity memory needs a capacity of at least 2")
    rows = windows.select(*COLUMNS)
    if memory is not None:
        rows = memory.select(*COLUMNS).unionByName(rows)
    rows = rows.withColumn("__s", cosine_to_ones("x"))
    ends = rows.groupBy(*STREAM).agg(F.min("__s").alias("__lo"), F.max("__s").alias("__hi"))
    rows = attach(rows, ends, STREAM)
    width = (F.col("__hi") - F.col("__lo")) / capacity
    inner = F.floor(F.try_divide(F.col("__s") - F.col("__lo"), width))
    label = (
        F.when(F.col("__s") == F.col("__lo"), F.lit(0))
        .when(F.col("__s") == F.col("__hi"), F.lit(capacity))
        .when(inner.between(1, capacity - 2), inner)
    )
    drawn = F.lit(0) if seed is None else F.xxhash64(F.lit(seed), "t_end", "k")
    at_end = F.col("__label").isin(0, capacity)
    turn = F.struct(F.when(at_end, F.lit(0)).otherwise(drawn), F.col("t_end"), F.col("k"))
    picked = (
        rows.withColumn("__label", label.cast("int"))
        .where(F.col("__label").isNotNull())
        .groupBy(*STREAM, "__label")
        .agg(F.min_by(F.struct("k", "t_end", "x", "y"), turn).alias("__row"))
    )
    return picked.select(*STREAM, "__row.*")


def _spread(memory: DataFrame, name: str) -> DataFrame:
    return memory.select(*STREAM, F.explode("x").alias("__v")).groupBy(*STREAM).agg(F.var_pop("__v").alias(name))


def variance_gate(memory: DataFrame, candidate: DataFrame, empty_accepts: bool = True) -> DataFrame:
    """Per stream, whether the candidate selection holds values of larger variance than the memory."""
    old, new = _spread(memory, "memory_variance"), _spread(candidate, "candidate_variance")
    larger = F.col("memory_variance") < F.col("candidate_variance")
    return new.join(old, STREAM, "left").withColumn("accepted", F.coalesce(larger, F.lit(empty_accepts)))


def gated_memory(memory: DataFrame, candidate: DataFrame, gate: DataFrame) -> DataFrame:
    """The candidate rows of accepted streams and the old rows of all others."""
    accepted = gate.where("accepted").select(*STREAM)
    fresh = attach(candidate.select(*COLUMNS), accepted, STREAM, "left_semi")
    return fresh.unionByName(attach(memory.select(*COLUMNS), accepted, STREAM, "left_anti"))
