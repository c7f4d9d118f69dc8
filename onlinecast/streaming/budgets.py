"""Training of waiting windows, budget after budget.

How many windows a training takes follows from the loss of the one before, so the budgets of a model come one after
the other. What a linear model learns by squared loss from any stretch of its windows depends on sums of products only:
tasks make running sums over blocks of positions, all blocks at once, and then one pass a model takes the
difference of two sums for each budget. That pass sees a row for each block and returns one for each budget; windows
are only joined with the budget that took them. Other models need the windows themselves and hold those of one budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.operators.batching import ARRIVAL, ERROR_MEMORY, one_budget
from onlinecast.operators.learning import fit_products
from onlinecast.operators.models import ModelSpec
from onlinecast.operators.promotion import QUEUE_ROWS
from onlinecast.operators.scoring import linear_pred
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import with_position
from onlinecast.plans.tables import written

STATE, TAKEN, STEP, WAITING = range(4)
FLUSH_ROWS = 5_000
BLOCK = 256
SPREAD = 4096

STATES = {
    "params": "array<double>", "sizes": "array<long>", "losses": "array<double>", "best": "double",
    "errors": "array<double>", "rate": "double", "elapsed": "double", "slope": "double", "intercept": "double",
}
BUDGET = {"step": "long", "start": "long", "size": "long", "epochs": "long", "before": "array<double>", "publish": "boolean"}
ROW = {"stream_id": "int", "k": "long", "at": "long", "x": "array<double>", "y": "array<double>"}
KEPT = {name: STATES[name] for name in ("params", "sizes", "losses", "best", "errors")}
OUT = {"kind": "int", "model_id": "long", "at": "long", "loss": "double", **BUDGET, **KEPT}
ROW_OUT = {**OUT, **ROW, "pred": "array<double>"}
ARROW = {
    "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
    "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()),
}


class Drained(NamedTuple):
    """Windows with what became of them, the trainings, and the models as they are after the last one."""

    taken: DataFrame
    waiting: DataFrame
    steps: DataFrame
    models: DataFrame


def _ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _arrow(fields: dict[str, str]) -> pa.Schema:
    return pa.schema([pa.field(name, ARROW[kind]) for name, kind in fields.items()])


def predictions(spec: ModelSpec, params: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not spec.linear:
        return np.asarray(spec.predict(params, x), float).reshape(len(x), -1)
    weights = params.reshape(spec.outputs, spec.look_back + 1)
    return x @ weights[:, :-1].T + weights[:, -1]


def fit(spec: ModelSpec, params: np.ndarray, x: np.ndarray, y: np.ndarray, epochs: int, lr: float) -> tuple[np.ndarray, float]:
    """The same for any model, from its windows."""
    for _ in range(epochs):
        last = params
        if spec.linear:
            miss = predictions(spec, params, x) - y
            slopes = (2 * miss if spec.loss == "mse" else np.sign(miss)) / y.size
            moved = np.hstack([slopes.T @ x, slopes.sum(0)[:, None]]).ravel()
        else:
            moved = np.asarray(spec.gradient(params, x, y), float)
        params = params - lr * moved
    miss = predictions(spec, last, x) - y
    return params, float(np.mean(miss * miss if spec.loss == "mse" else np.abs(miss)))


class _Model:
    """A model on its way from budget to budget."""

    def __init__(self, row: dict, spec: ModelSpec, lr: float, method: str):
        self.id, self.spec, self.lr, self.method = row["model_id"], spec, lr, method
        self.params = np.array(row["params"], float)
        self.sizes, self.losses, self.best = list(row["sizes"]), list(row["losses"]), row["best"]
        self.errors = list(row["errors"])
        self.tick = {name: row[name] for name in ("rate", "elapsed", "slope", "intercept")}
        self.steps = self.start = 0
        self._ask()

    def _ask(self) -> None:
        recent = sum(self.errors[:ERROR_MEMORY]) / ERROR_MEMORY
        self.epochs, self.size = one_budget(**self.tick, error=self.errors[-1], recent_error=recent, method=self.method)

    def trained(self, params: np.ndarray, loss: float, at: int) -> dict:
        """Note a training whose last window is of time ``at``, and ask for the next budget."""
        before, self.params = self.params, params
        self.sizes.append(self.size)
        self.losses.append(loss)
        mean, ready = sum(self.losses) / len(self.losses), sum(self.sizes) >= QUEUE_ROWS
        publish = ready and mean < self.best
        if publish:
            self.best = mean
        if ready:
            self.sizes.pop(0)
            self.losses.pop(0)
        out = {"kind": STEP, "model_id": self.id, "at": at, "loss": loss, "step": self.steps, "start": self.start,
               "size": self.size, "epochs": self.epochs, "before": before.tolist(), "publish": publish,
               "params": params.tolist() if publish else None}
        self.errors = [*self.errors, loss][-(ERROR_MEMORY + 1) :]
        self.steps, self.start = self.steps + 1, self.start + self.size
        self._ask()
        return out

    def end(self) -> dict:
        """The state to keep; ``start`` is the first position that waits."""
        return {"kind": STATE, "model_id": self.id, "step": self.steps, "start": self.start, "params": self.params.tolist(),
                "sizes": self.sizes, "losses": self.losses, "best": self.best, "errors": self.errors}


class _OnSums(_Model):
    """Trains on differences of running sums."""

    def __init__(self, *args):
        super().__init__(*args)
        wide = self.spec.look_back + 1 + self.spec.outputs
        self.place = np.triu_indices(wide)
        self.open, self.waits = np.zeros(len(self.place[0])), 0

    def take(self, row: dict) -> list[dict]:
        """Go over a block: every budget that ends in it trains, what is left of the last one stays open."""
        sums, times = np.asarray(row["sums"], float).reshape(-1, len(self.open)), row["times"]
        out, begin = [], 0
        while begin < len(times):
            end = min(len(times), begin + self.size - self.waits)
            self.open = self.open + sums[end - 1] - (sums[begin - 1] if begin else 0.0)
            self.waits += end - begin
            if self.waits == self.size:
                products = np.zeros((self.place[0].max() + 1,) * 2)
                products[self.place] = products[self.place[::-1]] = self.open
                params, loss = fit_products(self.spec, self.params, products, self.size, self.epochs, self.lr)
                out.append(self.trained(params, loss, times[end - 1]))
                self.open, self.waits = np.zeros(len(self.open)), 0
            begin = end
        return out

    def close(self) -> list[dict]:
        return [self.end()]


class _OnRows(_Model):
    """Trains on the windows of a budget, which it holds until there are enough."""

    def __init__(self, *args):
        super().__init__(*args)
        self.held: list[dict] = []

    def take(self, row: dict) -> list[dict]:
        self.held.append({c: row[c] for c in ("model_id", *ROW)})
        if len(self.held) < self.size:
            return []
        x, y = (np.array([r[c] for r in self.held], float) for c in ("x", "y"))
        pred, step = predictions(self.spec, self.params, x), self.steps
        params, loss = fit(self.spec, self.params, x, y, self.epochs, self.lr)
        out = [{**r, "kind": TAKEN, "step": step, "loss": loss, "x": None, "pred": p.tolist()} for r, p in zip(self.held, pred, strict=True)]
        out.append(self.trained(params, loss, max(r["at"] for r in self.held)))
        self.held = []
        return out

    def close(self) -> list[dict]:
        return [*({**r, "kind": WAITING} for r in self.held), self.end()]


def running_products(placed: DataFrame, spec: ModelSpec) -> DataFrame:
    """Running sums of the products of all pairs of (x, 1, y) over each block of ``BLOCK`` positions of a model.

    A row is a block: the sums behind each of its positions in one array, and the times of its windows.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("__at")
        x, y = (table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1) for c in ("x", "y"))
        wide = np.hstack([x, np.ones((len(table), 1)), y])
        left, right = np.triu_indices(wide.shape[1])
        sums = np.cumsum(wide[:, left] * wide[:, right], axis=0)
        return pa.table({
            "model_id": table["model_id"][:1], "block": table["block"][:1],
            "times": pa.array([table["at"].to_pylist()], ARROW["array<long>"]),
            "sums": pa.ListArray.from_arrays(pa.array([0, sums.size], pa.int32()), pa.array(sums.ravel())),
        })

    blocks = placed.withColumn("block", F.floor(F.col("__at") / BLOCK)).select("model_id", "block", "__at", "at", "x", "y")
    return blocks.groupBy("model_id", "block").applyInArrow(add, "model_id long, block long, times array<long>, sums array<double>")


def _pass(rows: DataFrame, states: DataFrame, order: list[str], out: dict[str, str], make) -> DataFrame:
    """Send the rows of each model, in order and behind its state, through what ``make`` makes of the state."""
    first = states.select("model_id", F.lit(0).alias("kind"), *[F.col(c).cast(t).alias(c) for c, t in STATES.items()])
    rows = rows.withColumn("kind", F.lit(1)).unionByName(first, allowMissingColumns=True)
    rows = rows.repartition("model_id").sortWithinPartitions("model_id", "kind", *order)
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, found = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if model is not None and model.id != row["model_id"]:
                    found += model.close()
                    model = None
                if row["kind"] == 0:
                    model = make(row)
                elif model is not None:
                    found += model.take(row)
                if len(found) >= FLUSH_ROWS:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found = []
        if model is not None:
            found += model.close()
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    return rows.mapInArrow(run, _ddl(out))


def drained(windows: DataFrame, states: DataFrame, spec: ModelSpec, lr: float, method: str) -> Drained:
    """Train each model on its waiting windows, oldest first, until fewer wait than its next budget asks for.

    ``states`` has a row for every model to train, with the columns of ``STATES``; windows of others wait on.
    """
    windows = windows.withColumn("at", F.unix_micros("t_end"))
    if not (spec.linear and spec.loss == "mse"):
        return _drained_rows(windows, states, spec, lr, method)
    placed = written(with_position(windows, ["model_id"], ARRIVAL, "__at"), "placed")
    found = _pass(running_products(placed, spec), states, ["block"], OUT, lambda row: _OnSums(row, spec, lr, method))
    found = written(found, "budgets")
    steps, models = found.where(F.col("kind") == STEP), found.where(F.col("kind") == STATE)
    placed = attach(placed, models.select("model_id", F.col("start").alias("__waits")), ["model_id"], "left")
    waits = F.col("__at") >= F.coalesce("__waits", F.lit(0))
    last = F.col("start") + F.col("size") - 1
    spread = steps.withColumn("__some", F.explode(F.sequence(F.floor(F.col("start") / SPREAD), F.floor(last / SPREAD))))
    some = F.col("__some") * SPREAD
    spread = spread.select(
        "model_id", "step", F.explode(F.sequence(F.greatest("start", some), F.least(last, some + SPREAD - 1))).alias("__at")
    )
    taken = placed.where(~waits).join(spread, ["model_id", "__at"])
    taken = attach(taken, steps.select("model_id", "step", "loss", F.col("before").alias("params")), ["model_id", "step"])
    taken = taken.withColumn("pred", linear_pred(spec)).drop("params", "__at", "__waits")
    return Drained(taken, placed.where(waits).drop("__at", "__waits"), steps, models)


def _drained_rows(windows: DataFrame, states: DataFrame, spec: ModelSpec, lr: float, method: str) -> Drained:
    known = states.select("model_id").distinct()
    own = attach(windows, known, ["model_id"], "left_semi").select("model_id", *ROW)
    order = ["at" if c == "t_end" else c for c in ARRIVAL]
    found = written(_pass(own, states, order, ROW_OUT, lambda row: _OnRows(row, spec, lr, method)), "budgets")
    found = found.withColumn("t_end", F.timestamp_micros("at"))
    waiting = found.where(F.col("kind") == WAITING).select("model_id", "t_end", *ROW)
    unknown = attach(windows, known, ["model_id"], "left_anti").select("model_id", "t_end", *ROW)
    kinds = [found.where(F.col("kind") == k) for k in (TAKEN, STEP, STATE)]
    return Drained(kinds[0], waiting.unionByName(unknown), kinds[1], kinds[2])
