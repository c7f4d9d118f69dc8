"""One query per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onlinecast.functions import stream_id
from onlinecast.operators import analytics, batching, learning, memory, parsing, promotion, registry, routing, scoring
from onlinecast.operators import windows as win
from onlinecast.operators.models import linear_model, mlp_model
from onlinecast.plans import ordering
from onlinecast.plans.tables import new_path, written
from onlinecast.sources import (
    append_results,
    decode_readings,
    format_window_record,
    parse_window_record,
    read_readings,
    read_results,
    read_windows,
    rejected_readings,
    write_results,
    write_windows,
)
from onlinecast.sources.readings import PREFIX
from onlinecast.sources.registry import deploy
from onlinecast import streaming
from onlinecast.streaming import lookback_windows_stream as lookback_stream
from onlinecast.streaming import training_windows_stream as training_stream
from workload import inputs
from workload.inputs import HOUR, INFERENCE, MESSAGE_SCHEMA, TICK, TRAINING

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def micros(name: str) -> Column:
    return F.unix_micros(name).alias(name)


def r6(column: str | Column, name: str | None = None) -> Column:
    """Rounded, without a negative zero."""
    value = F.col(column) if isinstance(column, str) else column
    return (F.round(value, 6) + 0.0).alias(name or column)


def long(column: str | Column, name: str | None = None) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("long").alias(name or column)


def items(windows: DataFrame, *keys: str | Column) -> DataFrame:
    """One row per value of ``x`` and ``y``, ``y`` counted on after ``x``."""
    values = F.concat("x", "y") if "y" in windows.columns else F.col("x")
    return windows.select(*keys, F.posexplode(values).alias("i", "v")).withColumn("i", long("i"))


# Sources and sinks


def message_frame(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    path = inputs.messages(spark, sf_dir, dirty)
    return read_readings(spark, "parquet", {"path": path}, schema=MESSAGE_SCHEMA)


@query
def source_readings(spark, sf_dir):
    raw = message_frame(spark, sf_dir)
    return raw.select("topic", long("stream_id"), micros("ts"), "event_id", F.col("payload").cast("string").alias("payload"))


@query
def sink_source_windows(spark, sf_dir):
    path = new_path(spark, "windows")
    write_windows(win.training_windows(inputs.readings(spark, sf_dir), 3, 1, 2, 2), "parquet", {"path": path})
    back = read_windows(spark, 3, "parquet", {"path": path}, streaming=False, schema="t_end timestamp, record string")
    return items(back, long("stream_id"), micros("t_end"))


@query
def sink_source_results(spark, sf_dir):
    path = new_path(spark, "results")
    write_results(analytics.number_results(inputs.documents(spark, sf_dir)), path, restart=True)
    each = [read_results(spark, path, model) for model in range(inputs.MODELS)]
    return reduce(DataFrame.unionByName, each).select(
        "model_id", "seq", "batch_id", long("stream_id"), long(F.size("pred"), "n"), micros("ts"), r6("loss"), r6("average_loss")
    )


# Parsing


@query
def decoded_readings(spark, sf_dir):
    good = decode_readings(message_frame(spark, sf_dir, dirty=True))
    return good.select(long("stream_id"), micros("ts"), "event_id", "value")


@query
def quarantined_readings(spark, sf_dir):
    bad = rejected_readings(message_frame(spark, sf_dir, dirty=True))
    return bad.select("topic", "event_id", F.col("payload").cast("string").alias("payload"), "reason")


@query
def window_records(spark, sf_dir):
    windows = win.lookback_windows(inputs.readings(spark, sf_dir), 3)
    return format_window_record(windows).select(long("stream_id"), "k", "record")


@query
def parsed_records(spark, sf_dir):
    windows = win.training_windows(inputs.readings(spark, sf_dir), 3, 2, 1, 2)
    return items(parse_window_record(format_window_record(windows), 3), long("stream_id"), "k")


@query
def stream_ids(spark, sf_dir):
    topics = inputs.readings(spark, sf_dir).select("event_id", "topic")
    return topics.select("event_id", long(stream_id("topic", PREFIX), "stream_id"))


@query
def stream_catalog(spark, sf_dir):
    catalog = parsing.stream_catalog(inputs.readings(spark, sf_dir), "sensor.")
    return catalog.select("topic", "namespace", "name", "readings", micros("first_ts"), micros("last_ts"))


@query
def observed_values(spark, sf_dir):
    windows = win.lookback_windows(inputs.readings(spark, sf_dir), 3, 2)
    return windows.select(long("stream_id"), "k", parsing.observed_value().alias("observed"))


@query
def results_for_model(spark, sf_dir):
    results = inputs.results(spark, sf_dir)
    kept = parsing.results_for_model(results, inputs.subscribed(spark, sf_dir))
    return kept.select("model_id", "seq", long("stream_id"), r6("loss"), micros("updated_at"))


# Windows


@query
def lookback_windows(spark, sf_dir):
    windows = win.lookback_windows(inputs.readings(spark, sf_dir), 5, 2)
    return items(windows, long("stream_id"), "k", micros("t_end"))


@query
def lookback_windows_lineitem(spark, sf_dir):
    windows = win.lookback_windows(inputs.line_readings(spark, sf_dir), 36)
    return windows.select(
        long("stream_id"), "k", micros("t_end"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("total")
    )


@query
def lookback_windows_cut(spark, sf_dir):
    """Long streams in runs; of readings of a day the ids fall."""
    rows = inputs.line_readings(spark, sf_dir).withColumn("event_id", -F.col("event_id"))
    windows = win.lookback_windows(rows, 36, 1, group_rows=40)
    return windows.select(
        long("stream_id"), "k", micros("t_end"), F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("total")
    )


@query
def running_cut(spark, sf_dir):
    """Running sums over models in runs, by a flag first and then by ids over the whole range of longs."""
    wide = F.when(F.col("event_id") % 2 == 0, 9223372036854775000 - F.col("event_id")).otherwise(
        F.col("event_id") - 9223372036854775000
    )
    events = inputs.table(spark, sf_dir, "events").select(
        (F.col("user_id") % inputs.MODELS).alias("model_id"), (F.col("value") > 50).alias("late"), wide.alias("wide"), "event_id"
    )
    totals = ordering.running(events, ["model_id"], ["late", "wide"], "event_id", "sum", "total", group_rows=30)
    return totals.select("model_id", "event_id", "total")


@query
def training_windows(spark, sf_dir):
    windows = win.training_windows(inputs.readings(spark, sf_dir), 4, 3, 2, 3)
    return items(windows, long("stream_id"), "k", micros("t_end"))


@query
def multi_stream_windows(spark, sf_dir):
    source = inputs.readings(spark, sf_dir)
    members = source.select("stream_id").distinct().withColumn("group_id", F.floor(F.col("stream_id") / 3))
    return items(win.multi_stream_windows(source, members, 3, 2), "group_id", "k", micros("t_end"))


@query
def model_windows(spark, sf_dir):
    windows = win.model_windows(inputs.readings(spark, sf_dir), inputs.subscribed(spark, sf_dir))
    values = F.concat("x", F.coalesce("y", F.array().cast("array<double>")))
    return windows.select(
        "model_id", long("stream_id"), "mode", "k", micros("t_end"), F.posexplode(values).alias("i", "v")
    ).withColumn("i", long("i"))


# Batches and budget


@query
def fixed_batches(spark, sf_dir):
    batches = batching.fixed_batches(inputs.inference_windows(spark, sf_dir), 32)
    return batches.select("model_id", "batch_id", long("pos"), long("stream_id"), "k")


@query
def batches_cut(spark, sf_dir):
    """Batches of models in runs."""
    batches = batching.fixed_batches(inputs.inference_windows(spark, sf_dir), 32, group_rows=25)
    return batches.select("model_id", "batch_id", long("pos"), long("stream_id"), "k")


@query
def adaptive_batches(spark, sf_dir):
    batches = batching.adaptive_batches(inputs.inference_windows(spark, sf_dir), 3, TICK)
    return batches.select("model_id", "tick", "batch_id", long("pos"), long("stream_id"), "k")


@query
def arrival_rate(spark, sf_dir):
    rates = batching.arrival_rate(inputs.model_of(inputs.readings(spark, sf_dir)), HOUR)
    return rates.select("model_id", "tick", "arrivals", "elapsed", r6("rate"))


@query
def fit_cost_model(spark, sf_dir):
    cost = batching.fit_cost_model(inputs.timings(spark, sf_dir))
    return cost.select("model_id", r6("slope"), r6("intercept"))


@query
def recent_error(spark, sf_dir):
    errors = batching.recent_error(inputs.training_losses(spark, sf_dir))
    return errors.select("model_id", "batch_id", r6("recent_error"))


def budget(spark, sf_dir, method):
    ticks = batching.arrival_rate(inputs.model_of(inputs.readings(spark, sf_dir)), HOUR)
    ticks = ticks.withColumnRenamed("arrivals", "backlog")
    ticks = ticks.withColumns({"error": (1 + F.col("tick") % 7) / 10, "recent_error": F.lit(0.3)})
    spent = batching.training_budget(ticks, batching.fit_cost_model(inputs.timings(spark, sf_dir)), method)
    return spent.select("model_id", "tick", "epochs", "batch_size", r6("wait_seconds"))


@query
def training_budget(spark, sf_dir):
    return budget(spark, sf_dir, "grid")


@query
def training_budget_descent(spark, sf_dir):
    return budget(spark, sf_dir, "real")


# Routing


@query
def subscribe(spark, sf_dir):
    routed = routing.subscribe(inputs.readings(spark, sf_dir), inputs.subscribed(spark, sf_dir))
    return routed.select("model_id", "mode", long("stream_id"), "event_id", "value")


@query
def merge_streams(spark, sf_dir):
    events = inputs.readings(spark, sf_dir).drop("topic")
    merged = routing.merge_streams([events, inputs.line_readings(spark, sf_dir)])
    return merged.select(long("stream_id"), micros("ts"), "event_id", "value")


@query
def asof_model(spark, sf_dir):
    batches = inputs.scored(spark, sf_dir).groupBy("model_id", "batch_id").agg(F.max("t_end").alias("ts"))
    return routing.asof_model(batches, inputs.registry(spark, sf_dir)).select("model_id", "batch_id", "version")


@query
def loss_gated_lookup(spark, sf_dir):
    requests = inputs.table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 12).alias("model_id"), F.col("value").alias("loss")
    )
    answers = routing.loss_gated_lookup(requests, inputs.registry(spark, sf_dir))
    return answers.select("event_id", "model_id", "status", "version")


@query
def reject_duplicates(spark, sf_dir):
    requests = inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.concat(F.lit("Supplier#"), F.lpad((F.col("user_id") * 2).cast("string"), 9, "0")).alias("name"),
    )
    return routing.reject_duplicates(requests, inputs.models(spark, sf_dir)).select("request_id", "name", "accepted")


def names_to_withdraw(spark, sf_dir):
    number = (F.col("user_id") * 3).cast("string")
    name = F.concat(F.lit("Supplier#"), F.lpad(number, 9, "0"))
    return inputs.table(spark, sf_dir, "events").select("event_id", name.alias("name"))


@query
def withdraw(spark, sf_dir):
    left = routing.withdraw(inputs.models(spark, sf_dir), names_to_withdraw(spark, sf_dir))
    return left.select("model_id", "name")


@query
def withdraw_status(spark, sf_dir):
    return routing.withdraw_status(inputs.models(spark, sf_dir), names_to_withdraw(spark, sf_dir)).select(
        "event_id", "name", "status"
    )


# Registry


@query
def publish(spark, sf_dir):
    known = inputs.registry(spark, sf_dir)
    updates = inputs.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 12).alias("model_id"),
        F.col("ts").cast("timestamp").alias("update_time"),
        F.col("value").alias("loss"),
        F.array(F.col("value")).alias("params"),
    )
    grown = registry.publish(known, updates)
    return grown.select("model_id", "version", micros("update_time"), "loss", long(F.size("params"), "n"))


@query
def current_models(spark, sf_dir):
    current = registry.current_models(inputs.registry(spark, sf_dir))
    return current.select("model_id", "version", "num_push", micros("update_time"), "loss")


@query
def weight_change(spark, sf_dir):
    changes = registry.weight_change(inputs.registry(spark, sf_dir))
    return changes.select("model_id", "version", r6("distance"), "changed")


@query
def list_models(spark, sf_dir):
    return registry.list_models(inputs.models(spark, sf_dir), inputs.registry(spark, sf_dir))


@query
def count_by_state(spark, sf_dir):
    return registry.count_by_state(inputs.models(spark, sf_dir))


# Scoring


@query
def score(spark, sf_dir):
    rows = inputs.scored(spark, sf_dir)
    return rows.select("model_id", "batch_id", long("stream_id"), "k", r6(F.col("pred")[0], "pred"), "true")


@query
def score_two_outputs(spark, sf_dir):
    spec = linear_model(4, outputs=2, init=[0.1, 0.2, 0.3, 0.4, 1.0, 0.4, 0.3, 0.2, 0.1, -1.0])
    windows = win.lookback_windows(inputs.line_readings(spark, sf_dir), 4, 2)
    rows = scoring.score(windows, list(spec.init), spec)
    return rows.select(long("stream_id"), "k", r6(F.col("pred")[0], "pred0"), r6(F.col("pred")[1], "pred1"))


@query
def score_versions(spark, sf_dir):
    rows = batching.adaptive_batches(inputs.inference_windows(spark, sf_dir), 3, TICK)
    batches = rows.groupBy("model_id", "batch_id").agg(F.max("t_end").alias("ts"))
    known = inputs.registry(spark, sf_dir)
    versions = routing.asof_model(batches, known).drop("ts")
    rows = rows.join(versions, ["model_id", "batch_id"])
    again = scoring.score(rows, known, INFERENCE)
    return again.select("model_id", "batch_id", long("stream_id"), "k", "version", r6(F.col("pred")[0], "pred"))


@query
def one_step_rmse(spark, sf_dir):
    losses = scoring.one_step_rmse(inputs.scored(spark, sf_dir))
    return losses.select("model_id", "batch_id", long("stream_id"), r6("loss"))


@query
def one_step_rmse_model(spark, sf_dir):
    losses = scoring.one_step_rmse(inputs.scored(spark, sf_dir), scope="model")
    return losses.select("model_id", "batch_id", long("stream_id"), r6("loss"))


@query
def rolling_loss(spark, sf_dir):
    losses = scoring.rolling_loss(scoring.one_step_rmse(inputs.scored(spark, sf_dir)))
    return losses.select("model_id", "batch_id", long("stream_id"), r6("loss"), r6("average_loss"))


@query
def result_documents(spark, sf_dir):
    documents = scoring.result_documents(scoring.one_step_errors(inputs.scored(spark, sf_dir)))
    return documents.select(
        "model_id",
        "batch_id",
        long("stream_id"),
        micros("ts"),
        r6("loss"),
        F.posexplode(F.arrays_zip("pred", "true")).alias("i", "item"),
    ).select("model_id", "batch_id", "stream_id", "ts", "loss", long("i"), r6("item.pred", "pred"), F.col("item.true").alias("true"))


@query
def losses(spark, sf_dir):
    windows = inputs.learning_windows(spark, sf_dir)
    rows = scoring.score(windows, inputs.parameters(spark, sf_dir), TRAINING)
    return rows.groupBy("model_id").agg(
        r6(scoring.loss("mse"), "mse"), r6(scoring.loss("mae"), "mae")
    )


# Learning


@query
def gradient(spark, sf_dir):
    batches = inputs.learning_batches(spark, sf_dir)
    grads = learning.gradient(batches, inputs.parameters(spark, sf_dir), TRAINING, ["model_id", "batch_id"])
    return grads.select("model_id", "batch_id", long("p"), r6("g"))


@query
def fit_epochs(spark, sf_dir):
    windows = inputs.learning_windows(spark, sf_dir)
    fitted = learning.fit_epochs(windows, inputs.parameters(spark, sf_dir), TRAINING, 2, 0.05)
    return fitted.select("model_id", r6("loss"), F.posexplode("params").alias("p", "w")).select(
        "model_id", "loss", long("p"), r6("w")
    )


@query
def ring_memory(spark, sf_dir):
    kept = memory.ring_memory(None, inputs.learning_windows(spark, sf_dir), 10)
    return kept.select("model_id", long("stream_id"), "k")


@query
def ring_memory_reset(spark, sf_dir):
    kept = memory.ring_memory_reset(inputs.learning_batches(spark, sf_dir), 50)
    return kept.select("model_id", long("stream_id"), "k")


@query
def similarity_memory(spark, sf_dir):
    kept = memory.similarity_memory(None, inputs.vectors(spark, sf_dir), 10, seed=None)
    return kept.select(long("stream_id"), "k")


@query
def variance_gate(spark, sf_dir):
    rows = inputs.vectors(spark, sf_dir)
    gate = memory.variance_gate(memory.ring_memory(None, rows, 20), memory.similarity_memory(None, rows, 20, seed=None))
    return gate.select(long("stream_id"), r6("memory_variance"), r6("candidate_variance"), "accepted")


def latest_gradients(spark, sf_dir):
    """Gradients on the newest windows of each stream, as its memory, and on all other windows of a model."""
    windows = written(inputs.learning_windows(spark, sf_dir), "windows")
    params = inputs.parameters(spark, sf_dir)
    kept = written(memory.ring_memory(None, windows, 7), "kept")
    others = windows.join(kept, ["model_id", "stream_id", "k"], "left_anti")
    current = written(learning.gradient(others, params, TRAINING), "current")
    return params, current, written(learning.memory_gradients(kept, params, TRAINING), "memories")


@query
def memory_gradients(spark, sf_dir):
    _, _, memories = latest_gradients(spark, sf_dir)
    return memories.select("model_id", long("stream_id"), long("p"), r6("g"))


@query
def conflicts(spark, sf_dir):
    _, current, memories = latest_gradients(spark, sf_dir)
    return learning.conflicts(current, memories).select("model_id", long("stream_id"), r6("dot"), "conflict")


@query
def project_gradient_average(spark, sf_dir):
    _, current, memories = latest_gradients(spark, sf_dir)
    return learning.project_gradient(current, memories, method="average").select("model_id", long("p"), r6("g"))


@query
def project_gradient_exact(spark, sf_dir):
    _, current, memories = latest_gradients(spark, sf_dir)
    return learning.project_gradient(current, memories).select("model_id", long("p"), r6("g"))


@query
def apply_update(spark, sf_dir):
    params, current, _ = latest_gradients(spark, sf_dir)
    moved = learning.apply_update(params, current, 0.05)
    return moved.select("model_id", F.posexplode("params").alias("p", "w")).select("model_id", long("p"), r6("w"))


@query
def promotion_gate(spark, sf_dir):
    losses = inputs.training_losses(spark, sf_dir).withColumn("rows", F.lit(32))
    gate = promotion.promotion_gate(losses, batch_size=32)
    return gate.select("model_id", "batch_id", r6("mean_loss"), "publish")


@query
def promotion_gate_varying(spark, sf_dir):
    gate = promotion.promotion_gate(inputs.training_losses(spark, sf_dir))
    return gate.select("model_id", "batch_id", r6("mean_loss"), "publish")


@query
def user_model(spark, sf_dir):
    spec = mlp_model(2, 4)
    windows = inputs.learning_windows(spark, sf_dir)
    start = inputs.parameters(spark, sf_dir).withColumn("params", F.array(*[F.lit(v) for v in spec.init]))
    moved = learning.apply_update(start, learning.gradient(windows, start, spec), 0.05)
    return learning.evaluate(windows, moved, spec).select("model_id", r6("loss"))


# Result analytics


@query
def series(spark, sf_dir):
    points = analytics.series(inputs.results(spark, sf_dir))
    return points.select(
        "model_id", long("stream_id"), "seq", long("pos"), r6("pred"), "true", r6("loss"), r6("average_loss"), micros("ts")
    )


@query
def update_markers(spark, sf_dir):
    results = inputs.results(spark, sf_dir)
    streams = inputs.model_of(inputs.readings(spark, sf_dir)).select("model_id", "stream_id")
    points = analytics.with_update_markers(analytics.series(results), results, streams)
    return points.select("model_id", long("stream_id"), "seq", long("pos"), r6("pred"), r6("loss"), micros("ts"), "is_update")


@query
def axis_maxima(spark, sf_dir):
    maxima = analytics.axis_maxima(inputs.results(spark, sf_dir))
    return maxima.select("model_id", "documents", r6("max_value"), r6("max_loss"), r6("max_average_loss"))


@query
def new_since(spark, sf_dir):
    results = inputs.results(spark, sf_dir)
    half = results.groupBy("model_id").agg(F.floor(F.count(F.lit(1)) / 2).alias("origin"))
    return analytics.new_since(results, half).select("model_id", "seq", long("stream_id"), r6("loss"))


@query
def new_counts(spark, sf_dir):
    return analytics.new_counts(inputs.results(spark, sf_dir), 100)


@query
def merge_maxima(spark, sf_dir):
    results = inputs.results(spark, sf_dir)
    old = analytics.axis_maxima(results.where("seq < 100"))
    merged = analytics.merge_maxima(old, analytics.axis_maxima(analytics.new_since(results, 100)))
    return merged.select("model_id", "documents", r6("max_value"), r6("max_loss"), r6("max_average_loss"))


@query
def latest_points(spark, sf_dir):
    points = analytics.latest_points(analytics.series(inputs.results(spark, sf_dir)), 20)
    return points.select("model_id", long("stream_id"), "seq", long("pos"), r6("pred"), "true")


# Streaming

NOW = {"availableNow": True}


@query
def lookback_windows_stream(spark, sf_dir):
    root = new_path(spark, "windows")

    def start(readings):
        windows = lookback_stream(readings, 5, 2)
        writer = windows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        return writer.trigger(**NOW).start(f"{root}/table")

    inputs.replay(spark, sf_dir, start)
    return items(spark.read.parquet(f"{root}/table"), long("stream_id"), "k", micros("t_end"))


@query
def training_windows_stream(spark, sf_dir):
    root = new_path(spark, "windows")

    def start(readings):
        windows = training_stream(readings, 3, 1, 2, 2)
        return write_windows(windows, "parquet", {"path": f"{root}/table"}, f"{root}/checkpoint", trigger=NOW)

    inputs.replay(spark, sf_dir, start)
    schema = "t_end timestamp, record string"
    back = read_windows(spark, 3, "parquet", {"path": f"{root}/table"}, streaming=False, schema=schema)
    return items(back, long("stream_id"), micros("t_end"))


@query
def windows_job(spark, sf_dir):
    paths = inputs.job_paths(spark, "windows")
    shape = win.WindowShape(4, 3, 2, 3)
    inputs.replay(spark, sf_dir, lambda readings: streaming.windows_job(readings, shape, paths, NOW))
    return items(spark.read.parquet(paths.results), long("stream_id"), "k", micros("t_end"))


@query
def inference_job(spark, sf_dir):
    paths = inputs.job_paths(spark, "inference")
    inputs.deployed(spark, sf_dir, list(INFERENCE.init), paths)
    members = inputs.memberships(spark, sf_dir)

    def start(readings):
        return streaming.inference_job(readings, members, INFERENCE, win.WindowShape(3), paths, trigger=NOW)

    inputs.replay(spark, sf_dir, start)
    return inference_documents(read_results(spark, paths.results))


def inference_documents(results):
    return results.select(
        "model_id", "seq", "batch_id", long("stream_id"), long(F.size("pred"), "n"), micros("ts"), r6("loss"), r6("average_loss")
    )


@query
def inference_job_shapes(spark, sf_dir):
    """Models with even ids look back over three readings, the others over two and start at every second."""
    paths = inputs.job_paths(spark, "inference")
    even = F.col("model_id") % 2 == 0
    members = inputs.memberships(spark, sf_dir).withColumns(
        {"look_back": F.when(even, 3).otherwise(2), "shift": F.when(even, 1).otherwise(2)}
    )
    weights = [F.array(*[F.lit(v) for v in linear_model(n).init]) for n in (3, 2)]
    models = members.select("model_id").distinct().select(
        "model_id", F.timestamp_seconds(F.lit(1704067200)).alias("create_time"), F.when(even, weights[0]).otherwise(weights[1]).alias("params")
    )
    deploy(models, paths.registry)

    def start(readings):
        return streaming.inference_jobs(readings, members, linear_model, paths, trigger=NOW)

    inputs.replay(spark, sf_dir, start)
    return inference_documents(read_results(spark, paths.results))


def trained(spark, sf_dir, start_job):
    """Documents of a training job on the scaled readings."""
    paths = inputs.job_paths(spark, "training")
    inputs.deployed(spark, sf_dir, [0.5, 0.25, 0.1], paths)
    members = inputs.memberships(spark, sf_dir)
    shape = win.WindowShape(2, 1, 1, 1)

    def start(readings):
        scaled = readings.withColumn("value", F.col("value") / 100)
        return start_job(scaled, members, TRAINING, shape, paths)

    inputs.replay(spark, sf_dir, start)
    return read_results(spark, paths.results).select(
        "model_id", "seq", "batch_id", long("stream_id"), long(F.size("pred"), "n"), r6(F.array_max("pred"), "top"), r6("loss")
    )


@query
def incremental_job(spark, sf_dir):
    seconds = 20 * F.col("l_quantity") + 100 * F.col("l_tax")
    rows = inputs.table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % inputs.MODELS).alias("model_id"), F.col("l_quantity").alias("work"), seconds.alias("seconds")
    )
    cost = batching.fit_cost_model(rows)

    def start(*args):
        return streaming.incremental_job(*args[:4], cost, args[4], lr=0.05, trigger=NOW)

    return trained(spark, sf_dir, start)


@query
def continual_job(spark, sf_dir):
    def start(*args):
        return streaming.continual_job(*args, lr=0.05, memory="ring", capacity=4, projection="average", trigger=NOW)

    return trained(spark, sf_dir, start)


@query
def continual_job_batches(spark, sf_dir):
    """Steps on 80 windows of a model each, whatever a micro-batch holds."""

    def start(*args):
        return streaming.continual_job(
            *args, lr=0.05, memory="ring", capacity=4, projection="average", batch_size=80, trigger=NOW
        )

    return trained(spark, sf_dir, start)


@query
def continual_job_similarity(spark, sf_dir):
    def start(*args):
        return streaming.continual_job(*args, lr=0.05, memory="similarity", capacity=8, optimizer="adam", trigger=NOW)

    return trained(spark, sf_dir, start)


@query
def scheduled_continual_job(spark, sf_dir):
    def start(*args):
        return streaming.scheduled_continual_job(*args, lr=0.05, capacity=8, trigger=NOW)

    return trained(spark, sf_dir, start)


@query
def summary_job(spark, sf_dir):
    """Documents are written in three parts; after each the summary goes on."""
    paths = inputs.job_paths(spark, "summary")
    results = written(inputs.results(spark, sf_dir), "results")
    numbers = results.agg(F.max("seq")).first()[0] + 1
    for part in range(inputs.SLICES):
        append_results(results.where(F.floor(F.col("seq") * inputs.SLICES / numbers) == part), paths.results, part)
        streaming.summary_job(spark, paths, NOW).awaitTermination()
    maxima = streaming.read_summary(spark, paths)
    return maxima.select("model_id", "documents", r6("max_value"), r6("max_loss"), r6("max_average_loss"))
