"""Continuous training of every model: predict, learn, remember, publish when better."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from onlinecast.operators.batching import ARRIVAL, ERROR_MEMORY, FIRST_ERROR, numbered_batch
from onlinecast.operators.learning import (
    MARGIN,
    apply_update,
    evaluate,
    gradient,
    memory_gradients,
    project_gradient,
)
from onlinecast.operators.memory import gated_memory, ring_memory, similarity_memory, variance_gate
from onlinecast.operators.models import ModelSpec
from onlinecast.operators.promotion import FIRST_BEST, QUEUE_ROWS
from onlinecast.operators.scoring import linear_pred, loss, result_documents, score
from onlinecast.operators.windows import TAIL_SCHEMA, WindowShape, continued_windows
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import with_position
from onlinecast.plans.tables import VersionedTable, passing_tables, written
from onlinecast.sources.registry import append_registry, read_deployed
from onlinecast.sources.results import append_results
from onlinecast.streaming.budgets import drained
from onlinecast.streaming.state import JobPaths, run_batches
from onlinecast.streaming.turns import promoted, stepped

PAIR = ["model_id", "stream_id"]
WINDOWS = "model_id long, stream_id int, k long, t_end timestamp, x array<double>, y array<double>"
PARAMS = "model_id long, params array<double>, m array<double>, v array<double>, t int"
QUEUE = "model_id long, sizes array<long>, losses array<double>, best double"
ERRORS = "model_id long, at timestamp, errors array<double>, rate double"
PROGRESS = "model_id long, batches long, versions long"
RING_NAMES = ("ring", "ringbuffer", "ring_buffer")
SIMILARITY_NAMES = ("similarity", "cossim")

# Windows in one document; those of a longer batch have several, numbered by ``part``.
DOCUMENT_ROWS = 10_000


class _Trainer:
    """State and bookkeeping shared by the training jobs of one model family."""

    def __init__(self, readings, subscriptions, spec, shape, paths):
        self.spark = readings.sparkSession
        self.spec, self.shape, self.paths = spec, shape, paths
        self.pairs = subscriptions.select(*PAIR).distinct()
        self.tails = self.table("tails", TAIL_SCHEMA, ["stream_id"])
        self.params = self.table("params", PARAMS, ["model_id"])
        self.queue = self.table("queue", QUEUE, ["model_id"])
        self.counts = self.table("counts", "model_id long, documents long", ["model_id"])

    def table(self, name: str, schema: str, keys: list[str], compact: int = 20) -> VersionedTable:
        return self.paths.table(self.spark, name, schema, keys, compact)

    def windows(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Training windows the micro-batch completes, for every subscribed model."""
        windows, tail = continued_windows(batch, self.tails.read(batch_id), self.shape)
        self.tails.write(tail, batch_id)
        return written(attach(windows, self.pairs, ["stream_id"]), "windows")

    def current(self, windows: DataFrame, batch_id: int) -> DataFrame:
        """Parameters of the models with windows: as trained last, else as deployed."""
        touched = windows.select("model_id").distinct()
        trained = self.params.read(batch_id)
        deployed = read_deployed(self.spark, self.paths.registry).select("model_id", "params")
        fresh = deployed.join(trained, "model_id", "left_anti")
        both = trained.unionByName(fresh, allowMissingColumns=True)
        return written(both.join(touched, "model_id", "left_semi"), "current")

    def finish(
        self, windows: DataFrame, before: DataFrame, after: DataFrame, losses: DataFrame, version: int, replay_from: int
    ) -> None:
        """Store parameters, documents and publications of a training step on windows with ``batch_id``."""
        self.params.write(_with_optimizer_state(after), version, replay_from=replay_from)
        after = self.params.read(version + 1)
        publications = self._promote(windows, losses, version, replay_from)
        updates = publications.join(after.select("model_id", "params"), "model_id")
        updates = updates.select("model_id", "update_time", "loss", "params")
        append_registry(updates, self.paths.registry, version, self.paths.job)
        rows = score(windows, before, self.spec)
        self.document(attach(rows, losses, ["model_id"]), publications, version, replay_from)

    def _promote(self, windows: DataFrame, losses: DataFrame, version: int, replay_from: int) -> DataFrame:
        """Queue the step's loss; models whose queue is long enough and better than ever are published."""
        sizes = windows.groupBy("model_id", "batch_id").agg(
            F.count(F.lit(1)).alias("size"), F.max("t_end").alias("update_time")
        )
        rows = losses.join(sizes, "model_id").join(self.queue.read(version), "model_id", "left")
        none = F.array()
        rows = rows.select(
            "model_id",
            "batch_id",
            "update_time",
            "loss",
            F.concat(F.coalesce("sizes", none.cast("array<long>")), F.array("size")).alias("sizes"),
            F.concat(F.coalesce("losses", none.cast("array<double>")), F.array("loss")).alias("losses"),
            F.coalesce("best", F.lit(FIRST_BEST)).alias("best"),
        )
        held = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
        mean = F.aggregate("losses", F.lit(0.0), lambda a, v: a + v) / F.size("losses")
        ready = F.col("ready")
        rows = written(
            rows.withColumn("ready", held >= QUEUE_ROWS)
            .withColumn("publish", F.col("ready") & (mean < F.col("best")))
            .withColumn("best", F.when(F.col("publish"), mean).otherwise(F.col("best")))
            .withColumn("sizes", F.when(ready, F.slice("sizes", F.lit(2), F.size("sizes"))).otherwise(F.col("sizes")))
            .withColumn("losses", F.when(ready, F.slice("losses", F.lit(2), F.size("losses"))).otherwise(F.col("losses"))),
            "queue",
        )
        self.queue.write(rows, version, replay_from=replay_from)
        return rows.where("publish").select("model_id", "batch_id", "update_time", "loss")

    def document(self, rows: DataFrame, publications: DataFrame, version: int, replay_from: int | None = None) -> None:
        """Store documents of windows with ``batch_id``, ``pred`` and ``loss``, and the markers of publications."""
        at = with_position(rows, [*PAIR, "batch_id"], ["t_end", "k"], "__at")
        at = at.withColumns(
            {"part": F.floor(F.col("__at") / DOCUMENT_ROWS), "pos": (F.col("__at") % DOCUMENT_ROWS).cast("int")}
        )
        documents = result_documents(at.drop("__at"), true="y")
        markers = publications.select(
            "model_id",
            "batch_id",
            F.lit(None).cast("int").alias("stream_id"),
            F.col("update_time").alias("updated_at"),
        )
        numbered = with_position(
            documents.unionByName(markers, allowMissingColumns=True).withColumn("__late", F.col("stream_id").isNull()),
            ["model_id"],
            ["batch_id", "__late", "stream_id", "part"],
            "__at",
        )
        numbered = attach(numbered, self.counts.read(version), ["model_id"], "left")
        numbered = numbered.withColumn("seq", F.coalesce("documents", F.lit(0)) + F.col("__at"))
        numbered = written(numbered.drop("__at", "__late", "documents"), "numbered")
        counts = numbered.groupBy("model_id").agg((F.max("seq") + 1).alias("documents"))
        self.counts.write(counts, version, replay_from=replay_from)
        append_results(numbered, self.paths.results, version)


def _with_optimizer_state(params: DataFrame) -> DataFrame:
    kinds = {"m": "array<double>", "v": "array<double>", "t": "int"}
    for name, kind in kinds.items():
        if name not in params.columns:
            params = params.withColumn(name, F.lit(None).cast(kind))
    return params


def incremental_job(
    readings: DataFrame,
    subscriptions: DataFrame,
    spec: ModelSpec,
    shape: WindowShape,
    cost: DataFrame,
    paths: JobPaths,
    lr: float,
    method: str = "grid",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Fit each model on its waiting windows, oldest first, for as many rows and epochs as its budget gives.

    Arrivals are timed by the readings. ``cost(model_id, slope, intercept)`` comes from ``fit_cost_model``. A micro-batch
    takes budget after budget, each from the losses so far, until fewer windows wait than the next one asks for; those
    wait for the next micro-batch. A model without arrivals keeps its last rate. ``batch_id`` of a document is the
    micro-batch times 2^31 plus the number of the model's training in it.
    """
    trainer = _Trainer(readings, subscriptions, spec, shape, paths)
    waiting = trainer.table("waiting", WINDOWS, ["model_id"], compact=1)
    past = trainer.table("errors", ERRORS, ["model_id"])

    def step(batch: DataFrame, batch_id: int) -> None:
        arrived = trainer.windows(batch, batch_id)
        columns = [c.split()[0] for c in WINDOWS.split(", ")]
        backlog = written(waiting.read(batch_id).unionByName(arrived.select(*columns)), "backlog")

        clock = arrived.groupBy("model_id").agg(F.max("t_end").alias("now"), F.min("t_end").alias("start"), F.count(F.lit(1)).alias("new"))
        ticks = backlog.select("model_id").distinct().join(clock, "model_id", "left").join(past.read(batch_id), "model_id", "left")
        latest = batch.agg(F.max("ts")).first()[0]
        errors = F.coalesce("errors", F.array_repeat(F.lit(FIRST_ERROR), ERROR_MEMORY + 1))
        now = F.coalesce("now", F.lit(latest).cast("timestamp"))
        since = (F.unix_micros(now) - F.unix_micros(F.coalesce("at", "start"))) / 1e6
        seconds = F.greatest(since, F.lit(1e-3))
        ticks = ticks.select(
            "model_id",
            F.coalesce("now", "at").alias("at"),
            errors.alias("errors"),
            F.coalesce(F.col("new") / seconds, F.col("rate")).alias("rate"),
            seconds.alias("elapsed"),
        )
        queue = trainer.queue.read(batch_id).select(
            "model_id", "sizes", "losses", F.col("best").alias("__best")
        )
        states = trainer.current(backlog, batch_id).select("model_id", "params").join(ticks, "model_id")
        states = attach(states, cost, ["model_id"]).join(queue, "model_id", "left")
        states = states.where("rate is not null and slope is not null and intercept is not null").withColumns(
            {
                "sizes": F.coalesce("sizes", F.array().cast("array<long>")),
                "losses": F.coalesce("losses", F.array().cast("array<double>")),
                "best": F.coalesce("__best", F.lit(FIRST_BEST)),
            }
        )
        states = written(states, "states")
        done = drained(backlog, states, spec, lr, method)
        waiting.write(done.waiting.select(*columns), batch_id, whole=True)
        remembered = states.select("model_id", "at", "rate").join(done.models.select("model_id", "errors"), "model_id")
        past.write(remembered, batch_id)
        trained = done.models.where("step > 0")
        trainer.params.write(_with_optimizer_state(trained.select("model_id", "params")), batch_id)
        trainer.queue.write(trained, batch_id)
        number = numbered_batch(F.lit(batch_id).cast("long"), F.col("step"))
        published = done.steps.where("publish").withColumn("batch_id", number)
        published = published.withColumn("update_time", F.timestamp_micros("at"))
        append_registry(
            published.select("model_id", "update_time", "loss", "params", "batch_id"), paths.registry, batch_id, paths.job
        )
        taken = done.taken.withColumn("batch_id", number)
        taken = taken.select("model_id", "stream_id", "k", "t_end", "y", "batch_id", "pred", "loss")
        trainer.document(taken, published, batch_id)

    return run_batches(readings, step, paths, trigger)


def continual_job(
    readings: DataFrame,
    subscriptions: DataFrame,
    spec: ModelSpec,
    shape: WindowShape,
    paths: JobPaths,
    lr: float,
    memory: str = "ring",
    capacity: int = 100,
    scheduled: bool = False,
    projection: str = "exact",
    margin: float = MARGIN,
    optimizer: str = "sgd",
    seed: int | None = 0,
    trigger: dict | None = None,
    batch_size: int | None = None,
    adaptive: bool = False,
) -> StreamingQuery:
    """Gradient steps of every model, kept from undoing what its memory holds.

    ``batch_size`` windows of a model, in order of arrival, make a step, and a micro-batch takes as many steps as it fills. What is
    left waits for the next one, so the steps do not depend on how the source cuts the stream; ``adaptive`` steps on
    it, too. Without a size the windows of a micro-batch make one step. ``batch_id`` of a document is the number of the
    model's batch, or of the micro-batch. Batches of a linear model with squared loss, a ring memory, the average projection
    and plain steps take the same few jobs however many they are; all others are some jobs each.

    The memory is read before the new windows enter it. ``scheduled`` (similarity memory only) replaces a
    stream's memory only by a selection of larger variance, and projects only for models where that
    happened. Predictions in the documents are from before the step, losses from after it.
    """
    if memory not in RING_NAMES + SIMILARITY_NAMES:
        raise ValueError(f"unknown memory {memory!r}")
    if batch_size is not None and batch_size < 1:
        raise ValueError("a batch has at least one window")
    ring = memory in RING_NAMES
    scheduled = scheduled and not ring
    on_sums = ring and projection == "average" and optimizer == "sgd" and spec.linear and spec.loss == "mse"
    trainer = _Trainer(readings, subscriptions, spec, shape, paths)
    store = trainer.table("memory", WINDOWS, PAIR)
    carried = trainer.table("carried", WINDOWS, ["model_id"], compact=1)
    progress = trainer.table("progress", PROGRESS, ["model_id"], compact=1)

    def learn(windows: DataFrame, version: int, replay_from: int) -> None:
        """One step of every model with windows, on the state before ``version``."""
        before = trainer.current(windows, version)
        current = written(gradient(windows, before, spec), "gradient")
        held = written(attach(store.read(version), before.select("model_id"), ["model_id"], "left_semi"), "memory")

        streams = windows.select(*PAIR).distinct()
        touched = attach(held, streams, PAIR, "left_semi")
        new = windows.drop("batch_id")
        if ring:
            candidate = ring_memory(touched, new, capacity)
        else:
            candidate = similarity_memory(touched, new, capacity, seed)
        eligible = held
        if scheduled:
            candidate = written(candidate, "candidate")
            gate = written(variance_gate(touched, candidate), "gate")
            candidate = gated_memory(touched, candidate, gate)
            opened = gate.where("accepted").select("model_id").distinct()
            eligible = attach(held, opened, ["model_id"], "left_semi")
        store.write(candidate, version, replay_from=replay_from)

        if not eligible.isEmpty():
            memories = written(memory_gradients(eligible, before, spec), "memories")
            current = project_gradient(current, memories, margin, method=projection)
        after = written(apply_update(before, current, lr, optimizer), "after")
        losses = written(evaluate(windows, after, spec), "losses")
        trainer.finish(windows, before, after, losses, version, replay_from)

    def learn_all(windows: DataFrame, version: int) -> None:
        """The same for all steps of windows with ``turn``, where they need no more of the windows than sums of products."""
        before = trainer.current(windows, version)
        held = written(attach(store.read(version), before.select("model_id"), ["model_id"], "left_semi"), "memory")
        steps = written(stepped(windows, held, before, spec, lr, capacity), "steps")
        touched = attach(held, windows.select(*PAIR).distinct(), PAIR, "left_semi")
        store.write(ring_memory(touched, windows, capacity), version)

        rows = attach(windows, steps, ["model_id", "turn"]).withColumn("pred", linear_pred(spec))
        rows = rows.withColumn("params", F.col("moved")).withColumn("__moved", linear_pred(spec)).drop("params", "moved")
        losses = rows.groupBy("model_id", "turn", "batch_id").agg(
            loss(spec.loss, "__moved").alias("loss"), F.count(F.lit(1)).alias("size"), F.max("t_end").alias("update_time")
        )
        losses = written(losses, "losses")
        queued = written(promoted(losses, trainer.queue.read(version), FIRST_BEST), "queued")
        last = queued.groupBy("model_id").agg(F.max_by(F.struct("sizes", "losses", "best"), "turn").alias("last"))
        trainer.queue.write(last.select("model_id", "last.*"), version)
        after = steps.groupBy("model_id").agg(F.max_by("moved", "turn").alias("params"))
        trainer.params.write(_with_optimizer_state(before.drop("params").join(after, "model_id")), version)
        publications = queued.where("publish").select("model_id", "turn").join(losses, ["model_id", "turn"])
        publications = publications.join(steps.select("model_id", "turn", F.col("moved").alias("params")), ["model_id", "turn"])
        publications = written(publications.select("model_id", "batch_id", "update_time", "loss", "params"), "publications")
        append_registry(publications, paths.registry, version, paths.job)
        rows = attach(rows.drop("__moved"), losses.select("model_id", "turn", "loss"), ["model_id", "turn"])
        trainer.document(rows, publications, version)

    def one_step(batch: DataFrame, batch_id: int) -> None:
        windows = trainer.windows(batch, batch_id)
        if not windows.isEmpty():
            learn(windows.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id, batch_id)

    def steps(batch: DataFrame, batch_id: int) -> None:
        columns = [c.split()[0] for c in WINDOWS.split(", ")]
        arrived = trainer.windows(batch, batch_id).select(*columns)
        waiting = written(carried.read(batch_id).unionByName(arrived), "backlog")
        placed = with_position(waiting, ["model_id"], ARRIVAL, "__at")
        placed = written(placed.withColumn("__turn", F.floor(F.col("__at") / batch_size)), "turns")
        held = placed.groupBy("model_id").agg(F.count(F.lit(1)).alias("__held"))
        turns = F.ceil(F.col("__held") / batch_size) if adaptive else F.floor(F.col("__held") / batch_size)
        past = progress.read(batch_id)
        now = held.join(past, "model_id", "full").select(
            "model_id", F.coalesce("batches", F.lit(0)).alias("__first"), F.coalesce(turns, F.lit(0)).alias("__turns"), "versions"
        )
        now = written(now, "now")
        most, done = now.agg(F.max("__turns"), F.max("versions")).first()
        first = done or 0
        placed = attach(placed, now, ["model_id"]).withColumn("batch_id", F.col("__first") + F.col("__turn"))
        carried.write(placed.where(F.col("__turn") >= F.col("__turns")).select(*columns), batch_id, whole=True)
        full = F.col("__turn") < F.col("__turns")
        versions = most or 0
        if versions and on_sums:
            versions = 1
            learn_all(written(placed.where(full).select(*columns, "batch_id", F.col("__turn").alias("turn")), "windows"), first)
        else:
            for turn in range(versions):
                with passing_tables(trainer.spark):
                    mine = placed.where((F.col("__turn") == turn) & full)
                    learn(written(mine.select(*columns, "batch_id"), "windows"), first + turn, first)
        after = now.select(
            "model_id", (F.col("__first") + F.col("__turns")).alias("batches"), F.lit(first + versions).cast("long").alias("versions")
        )
        progress.write(after, batch_id, whole=True)

    return run_batches(readings, steps if batch_size else one_step, paths, trigger)


def scheduled_continual_job(*args, **options) -> StreamingQuery:
    """``continual_job`` with similarity memory behind the variance gate."""
    return continual_job(*args, **{"memory": "similarity", **options, "scheduled": True})
