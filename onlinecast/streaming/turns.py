"""All steps of a micro-batch on batches of a size, kept from undoing a ring memory on the average.

A step needs the parameters of the one before, but of the windows only sums of products: those of its batch, and those of each
stream's memory, which depend on the windows alone. Tasks make both for all steps at once; one pass a model then
takes a small row for each step. Windows meet their parameters afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onlinecast.operators.models import ModelSpec
from onlinecast.operators.promotion import QUEUE_ROWS
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import running, with_position
from onlinecast.plans.tables import written

PAIR = ["model_id", "stream_id"]
FLUSH_ROWS = 5_000


def _products(spec: ModelSpec) -> list[Column]:
    """Products of (x, 1) with itself, as the upper triangle by rows, and then with each target."""
    inputs = [F.element_at("x", i + 1) for i in range(spec.look_back)] + [F.lit(1.0)]
    targets = [F.element_at("y", o + 1) for o in range(spec.outputs)]
    pairs = [inputs[i] * inputs[j] for i, j in zip(*np.triu_indices(len(inputs)), strict=True)]
    return pairs + [x * y for y in targets for x in inputs]


def _slopes(spec: ModelSpec, weights: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Gradient of the mean squared loss for means of products."""
    wide = spec.look_back + 1
    place, matrix = np.triu_indices(wide), np.zeros((wide, wide))
    matrix[place] = matrix[place[::-1]] = products[: len(place[0])]
    cross = products[len(place[0]) :].reshape(spec.outputs, wide)
    return (2 * (weights.reshape(spec.outputs, wide) @ matrix - cross) / spec.outputs).ravel()


def memory_changes(memory: DataFrame, windows: DataFrame, spec: ModelSpec, capacity: int) -> DataFrame:
    """Per model and turn, how the sum of the streams' mean products and the number of streams with memory change by it.

    ``memory`` is what the rings hold before the first turn, and counts as turn -1. Of the rows of a stream that have come, the
    newest ``capacity`` are in its ring, so a window leaves it with the turn that brings the last of so many newer ones.
    """
    columns = [*PAIR, "k", "t_end", "x", "y", "turn"]
    rows = memory.withColumn("turn", F.lit(-1).cast("long")).select(*columns).unionByName(windows.select(*columns))
    rows = rows.withColumn("old", (F.col("turn") < 0).cast("long"))
    order = ["t_end", "k"]
    rows = running(with_position(rows, PAIR, order, "at"), PAIR, order, "old", "sum", "olds")
    rows = written(rows, "members")
    held = rows.groupBy(*PAIR).agg(F.sum("old").alias("all_old"))
    came = F.col("at") + 1 - F.col("olds")  # new windows of the stream up to this row
    rows = attach(rows, held, PAIR).withColumn("last", came + capacity - (F.col("all_old") - F.col("olds")))
    rows = rows.where(F.col("last") > came)
    turns = rows.where("old = 0").select(*PAIR, came.alias("last"), F.col("turn").alias("leaves"))
    rows = rows.join(turns, [*PAIR, "last"], "left").where("leaves is null or leaves > turn")
    names = [f"p{i}" for i in range(len(_products(spec)))]
    rows = rows.select(*PAIR, "turn", "leaves", *[p.alias(n) for p, n in zip(_products(spec), names, strict=True)])
    gone = rows.where("leaves is not null").select(*PAIR, F.col("leaves").alias("turn"), *[(-F.col(n)).alias(n) for n in names], F.lit(-1).alias("n"))
    events = rows.select(*PAIR, "turn", *names, F.lit(1).alias("n")).unionByName(gone)
    events = events.groupBy(*PAIR, "turn").agg(*[F.sum(n).alias(n) for n in names], F.sum("n").alias("n"))
    by_turn = Window.partitionBy(*PAIR).orderBy("turn")
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, 0)
    held = events.select(*PAIR, "turn", *[F.sum(n).over(so_far).alias(n) for n in [*names, "n"]])
    means = held.select(*PAIR, "turn", *[(F.col(n) / F.col("n")).alias(n) for n in names], F.lit(1).alias("streams"))
    changed = [(F.col(n) - F.coalesce(F.lag(n).over(by_turn), F.lit(0))).alias(n) for n in [*names, "streams"]]
    changes = means.select(*PAIR, "turn", *changed)
    return changes.groupBy("model_id", "turn").agg(
        F.array(*[F.sum(n) for n in names]).alias("change"), F.sum("streams").cast("long").alias("streams")
    )


def _in_turn(rows: DataFrame, order: list[str], schema: pa.Schema, ddl: str, start, take) -> DataFrame:
    """Send the rows of each model in order through ``take(state, row)``, from ``start(row)`` of its first one."""
    rows = rows.repartition("model_id").sortWithinPartitions("model_id", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, state, found = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["model_id"] != model:
                    model, state = row["model_id"], start(row)
                out = take(state, row)
                if out is not None:
                    found.append(out)
                if len(found) >= FLUSH_ROWS:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    return rows.mapInArrow(run, ddl)


def stepped(windows: DataFrame, memory: DataFrame, before: DataFrame, spec: ModelSpec, lr: float, capacity: int) -> DataFrame:
    """``model_id, turn, params, moved``: parameters before and after each turn of the models that have some."""
    sums = windows.groupBy("model_id", "turn").agg(
        F.array(*[F.avg(p) for p in _products(spec)]).alias("means")
    )
    changes = memory_changes(memory, windows, spec, capacity)
    changes = changes.withColumn("turn", F.col("turn") + 1)  # a memory is read by the next turn
    rows = attach(sums.join(changes, ["model_id", "turn"], "full"), before.select("model_id", "params"), ["model_id"])

    def start(row: dict) -> dict:
        return {"params": np.array(row["params"], float), "sum": 0.0, "streams": 0}

    def take(state: dict, row: dict) -> dict | None:
        if row["change"] is not None:
            state["sum"] = state["sum"] + np.array(row["change"], float)
            state["streams"] += row["streams"]
        if row["means"] is None:
            return None
        now = state["params"]
        g = _slopes(spec, now, np.array(row["means"], float))
        if state["streams"]:
            mean = _slopes(spec, now, state["sum"] / state["streams"])
            against = g @ mean
            g = g - (against / (mean @ mean) if against < 0 else 0.0) * mean
        state["params"] = now - lr * g
        return {"model_id": row["model_id"], "turn": row["turn"], "params": now.tolist(), "moved": state["params"].tolist()}

    arrays = pa.list_(pa.float64())
    schema = pa.schema([("model_id", pa.int64()), ("turn", pa.int64()), ("params", arrays), ("moved", arrays)])
    return _in_turn(rows, ["turn"], schema, "model_id long, turn long, params array<double>, moved array<double>", start, take)


def promoted(losses: DataFrame, queue: DataFrame, first_best: float) -> DataFrame:
    """``losses(model_id, turn, size, loss)`` with ``publish`` and the queue of the model behind each turn."""
    rows = losses.join(queue.select("model_id", "sizes", "losses", "best"), "model_id", "left")

    def start(row: dict) -> dict:
        best = first_best if row["best"] is None else row["best"]
        return {"sizes": list(row["sizes"] or []), "losses": list(row["losses"] or []), "best": best}

    def take(state: dict, row: dict) -> dict:
        sizes, losses = [*state["sizes"], row["size"]], [*state["losses"], row["loss"]]
        mean, ready = sum(losses) / len(losses), sum(sizes) >= QUEUE_ROWS
        publish = ready and mean < state["best"]
        if ready:
            sizes, losses = sizes[1:], losses[1:]
        state.update(sizes=sizes, losses=losses, best=mean if publish else state["best"])
        return {"model_id": row["model_id"], "turn": row["turn"], "publish": publish, **state}

    schema = pa.schema([
        ("model_id", pa.int64()), ("turn", pa.int64()), ("publish", pa.bool_()), ("sizes", pa.list_(pa.int64())),
        ("losses", pa.list_(pa.float64())), ("best", pa.float64()),
    ])
    ddl = "model_id long, turn long, publish boolean, sizes array<long>, losses array<double>, best double"
    return _in_turn(rows, ["turn"], schema, ddl, start, take)
