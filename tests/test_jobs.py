"""Streaming windows and jobs against batch operators and numpy replays."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from onlinecast import streaming
from onlinecast.operators import analytics, batching, scoring
from onlinecast.operators import windows as win
from onlinecast.operators.models import linear_model
from onlinecast.plans import tables
from onlinecast.plans.tables import VersionedTable
from onlinecast.sources import append_results, read_results, write_windows
from onlinecast.sources.registry import append_registry, deploy, read_registry
from onlinecast.streaming.state import JobPaths
from tests.frames import readings, same
from tests.test_learning import project

START = dt.datetime(2024, 1, 1)
NOW = {"availableNow": True}
SCHEMA = "stream_id int, ts timestamp, event_id long, value double"
PER_BATCH = 1 << 31


def deliver(spark, frame, folder, slices, start, between=None):
    """Write consecutive parts of the readings; run the query after each."""
    last = frame.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * slices / (last + 1))
    for i in range(slices):
        frame.where(part == i).write.mode("append").parquet(folder)
        start(spark.readStream.schema(SCHEMA).parquet(folder)).awaitTermination()
        if between:
            between(i)


def in_order(spark, seed, streams=3, n=90):
    """Readings whose event ids rise with time over all streams."""
    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(streams)), START + dt.timedelta(minutes=i), i, float(rng.normal())) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("size,shift", [(3, 2), (2, 5), (1, 1)])
def test_window_streams(spark, tmp_path, size, shift):
    _, frame = in_order(spark, size, n=150)
    for name, stream, batch in [
        ("look", lambda r: streaming.lookback_windows_stream(r, size, shift), win.lookback_windows(frame, size, shift)),
        ("train", lambda r: streaming.training_windows_stream(r, size, shift, 2, 3), win.training_windows(frame, size, shift, 2, 3)),
    ]:
        out = str(tmp_path / name)

        def start(rows):
            writer = stream(rows).writeStream.format("parquet").option("checkpointLocation", out + "-checkpoint")
            return writer.trigger(**NOW).start(out)

        deliver(spark, frame, out + "-in", 3, start)
        same(spark.read.parquet(out), batch)


@pytest.mark.parametrize("group_rows", [4, None])
def test_continued_windows(spark, group_rows):
    _, frame = in_order(spark, 5, n=150)
    for shape in (win.WindowShape(2, 7), win.WindowShape(3, 1, 2, 2)):
        tail = spark.createDataFrame([], win.TAIL_SCHEMA)
        found = None
        for i in range(3):
            part = frame.where(F.floor(F.col("event_id") / 50) == i)
            windows, tail = win.continued_windows(part, tail, shape, group_rows)
            tail = spark.createDataFrame(tail.collect(), win.TAIL_SCHEMA)
            windows = spark.createDataFrame(windows.collect(), windows.schema)
            found = windows if found is None else found.unionByName(windows)
        same(found, win.shaped_windows(frame, shape))


def paths(tmp_path):
    return JobPaths(*(str(tmp_path / n) for n in ("state", "checkpoint", "registry", "results")))


def deployed(spark, where, models, params):
    rows = [(m, START, [float(p) for p in params]) for m in models]
    deploy(spark.createDataFrame(rows, "model_id long, create_time timestamp, params array<double>"), where.registry)


def replay_last(where):
    """Forget that the last micro-batch was committed, so that the next start repeats it."""
    commits = os.path.join(where.checkpoint, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.remove(os.path.join(commits, last))
    for crc in (f".{last}.crc",):
        if os.path.exists(os.path.join(commits, crc)):
            os.remove(os.path.join(commits, crc))


@pytest.mark.parametrize("scope", ["stream", "model"])
def test_inference_job(spark, tmp_path, scope):
    rows, frame = in_order(spark, 6)
    where, spec = paths(tmp_path), linear_model(2)
    deployed(spark, where, [0, 1], [0.5, 0.5, 0.0])
    members = spark.createDataFrame([(0, 0), (0, 1), (1, 2)], "model_id long, stream_id int")

    def start(stream):
        return streaming.inference_job(stream, members, spec, win.WindowShape(2), where, scope=scope, trigger=NOW)

    def between(i):
        if i == 0:
            better = spark.createDataFrame([(0, START, 0.1, [1.0, 0.0, 2.0])], "model_id long, update_time timestamp, loss double, params array<double>")
            append_registry(better, where.registry, 0, "by hand")

    deliver(spark, frame, str(tmp_path / "in"), 3, start, between)
    got = read_results(spark, where.results)
    documents = got.where(F.col("stream_id").isNotNull())

    windows = win.lookback_windows(frame, 2).join(members, "stream_id")
    run = F.floor((F.unix_seconds("t_end") - F.lit(int(START.replace(tzinfo=dt.timezone.utc).timestamp()))) / 60 / 30)
    placed = batching.with_position(windows.withColumn("run", run), ["model_id", "run"], batching.ARRIVAL, "at")
    placed = placed.withColumn("batch_id", F.col("run") * PER_BATCH + F.floor(F.col("at") / 3)).withColumn(
        "pos", (F.col("at") % 3).cast("int")
    )
    old, new = F.array(*[F.lit(v) for v in (0.5, 0.5, 0.0)]), F.array(*[F.lit(v) for v in (1.0, 0.0, 2.0)])
    params = F.when((F.col("model_id") == 0) & (F.col("run") > 0), new).otherwise(old)
    scored = placed.withColumn("params", params).withColumn("pred", scoring.linear_pred(spec)).withColumn("true", F.element_at("x", -1))
    want = scoring.rolling_loss(scoring.result_documents(scoring.one_step_errors(scored, scope)), 3, scope)

    def plain(df):
        return df.select(
            "model_id", "batch_id", "stream_id", "pred", "true", "ts", F.round("loss", 9).alias("l"), F.round("average_loss", 9).alias("a")
        )

    same(plain(documents), plain(want))
    markers = got.where(F.col("stream_id").isNull()).collect()
    assert [(r.model_id, r.batch_id) for r in markers] == [(0, PER_BATCH - 1)]
    for m in (0, 1):
        ordered = got.where(F.col("model_id") == m).orderBy("batch_id", "stream_id").collect()
        assert [r.seq for r in ordered] == list(range(len(ordered)))

    before = sorted(map(repr, documents.collect()))
    replay_last(where)
    start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))).awaitTermination()
    spark.catalog.clearCache()
    again = read_results(spark, where.results).where(F.col("stream_id").isNotNull())
    assert sorted(map(repr, again.collect())) == before


def slices_of(frame_rows, slices, look_back=2, step=1, ahead=1):
    """Per slice, the training windows (stream, k, x, y) it completes."""
    streams, out = {}, []
    for i in range(slices):
        size = len(frame_rows)
        part = [r for r in frame_rows if r[2] * slices // size == i]
        done = []
        for s, _, _, v in part:
            streams.setdefault(s, []).append(v)
            n = len(streams[s])
            k = n - (look_back + step + ahead)
            if k >= 0:
                vals = streams[s]
                first = k + look_back + step - 1
                done.append((s, k, np.array(vals[k : k + look_back]), np.array(vals[first : first + ahead])))
        out.append(done)
    return out


def slope(params, windows):
    x1 = np.array([[*w[2], 1.0] for w in windows])
    y = np.array([w[3][0] for w in windows])
    return 2 * x1.T @ (x1 @ params - y) / len(y)


def mean_loss(params, windows):
    x1 = np.array([[*w[2], 1.0] for w in windows])
    y = np.array([w[3][0] for w in windows])
    return ((x1 @ params - y) ** 2).mean()


def test_continual_job(spark, tmp_path):
    rows, frame = in_order(spark, 7, n=120)
    where, spec, lr, capacity = paths(tmp_path), linear_model(2), 0.05, 4
    start_params = [0.9, -0.7, 0.2]
    deployed(spark, where, [0, 1], start_params)
    members = {0: [0, 1, 2], 1: [2]}
    frame_members = spark.createDataFrame([(m, s) for m, ss in members.items() for s in ss], "model_id long, stream_id int")

    def start(stream):
        return streaming.continual_job(
            stream, frame_members, spec, win.WindowShape(2, 1, 1, 1), where, lr, "ring_buffer", capacity, trigger=NOW
        )

    deliver(spark, frame, str(tmp_path / "in"), 3, start)
    replay_last(where)
    start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))).awaitTermination()

    results = {(r.model_id, r.batch_id, r.stream_id): r for r in read_results(spark, where.results).where("stream_id is not null").collect()}
    projections = 0
    final = {}
    for m, streams in members.items():
        params, memory = np.array(start_params), {}
        for b, done in enumerate(slices_of(rows, 3)):
            mine = [w for w in done if w[0] in streams]
            g = slope(params, mine)
            if memory:
                mems = np.array([slope(params, memory[s]) for s in sorted(memory)])
                projections += (mems @ g < 0).any()
                g = project(g, mems)
            for s in streams:
                kept = memory.get(s, []) + [w for w in mine if w[0] == s]
                if kept:
                    memory[s] = kept[-capacity:]
            before, params = params, params - lr * g
            for s in streams:
                here = [w for w in mine if w[0] == s]
                if here:
                    doc = results[m, b, s]
                    np.testing.assert_allclose(doc.pred, [np.dot([*w[2], 1.0], before) for w in here])
                    np.testing.assert_allclose(doc.true, [w[3][0] for w in here])
                    np.testing.assert_allclose(doc.loss, mean_loss(params, mine))
        final[m] = params
    assert projections
    stored = VersionedTable(spark, f"{where.state}/params", "model_id long, params array<double>", ["model_id"])
    for r in stored.read().collect():
        np.testing.assert_allclose(r.params, final[r.model_id])


@pytest.mark.parametrize("adaptive", [False, True])
def test_batches_of_a_size(spark, tmp_path, adaptive):
    """Steps on 11 windows: the same documents however the stream is cut, and after a repeated micro-batch."""
    rows, frame = in_order(spark, 19, n=100)
    spec, lr, capacity, size = linear_model(2), 0.05, 3, 20
    members = {0: [0, 1, 2], 1: [2]}
    pairs = spark.createDataFrame([(m, s) for m, ss in members.items() for s in ss], "model_id long, stream_id int")
    seen, final = {}, {}
    for slices in (1,) if adaptive else (1, 3, 7):
        where = paths(tmp_path / str(slices))
        deployed(spark, where, [0, 1], [0.9, -0.7, 0.2])
        source = str(tmp_path / str(slices) / "in")

        def start(stream):
            return streaming.continual_job(
                stream, pairs, spec, win.WindowShape(2, 1, 1, 1), where, lr, "ring", capacity, trigger=NOW,
                projection="average", batch_size=size, adaptive=adaptive,
            )

        deliver(spark, frame, source, slices, start)
        if slices == 3:
            replay_last(where)
            start(spark.readStream.schema(SCHEMA).parquet(source)).awaitTermination()
            spark.catalog.clearCache()
        got = read_results(spark, where.results).collect()
        seen[slices] = sorted((r.model_id, r.seq, r.batch_id, r.stream_id, tuple(np.round(r.pred or [], 9)), round(r.loss or 0, 9)) for r in got if r.stream_id is not None)
        stored = VersionedTable(spark, f"{where.state}/params", "model_id long, params array<double>", ["model_id"])
        final[slices] = {r.model_id: r.params for r in stored.read().collect()}
    assert len({tuple(v) for v in seen.values()}) == 1

    done = slices_of(rows, 1)[0]
    order = {(w.stream_id, w.k): (w.t_end, w.stream_id, w.k) for w in win.training_windows(frame, 2, 1, 1, 1).collect()}
    done.sort(key=lambda w: order[w[0], w[1]])
    turned = steps = 0
    for m, streams in members.items():
        mine = [w for w in done if w[0] in streams]
        params, memory = np.array([0.9, -0.7, 0.2]), {}
        count = -(-len(mine) // size) if adaptive else len(mine) // size
        steps += count
        for b in range(count):
            now = mine[b * size : (b + 1) * size]
            g = slope(params, now)
            if memory:
                mean = np.mean([slope(params, memory[s]) for s in memory], axis=0)
                if g @ mean < 0:
                    turned += 1
                    g = g - (g @ mean) / (mean @ mean) * mean
            for w in now:
                memory[w[0]] = (memory.get(w[0], []) + [w])[-capacity:]
            params = params - lr * g
            loss = mean_loss(params, now)
            assert {round(v, 7) for model, _, batch, _, _, v in seen[1] if (model, batch) == (m, b)} == {round(loss, 7)}
        assert {batch for model, _, batch, *_ in seen[1] if model == m} == set(range(count))
        for found in final.values():
            np.testing.assert_allclose(found[m], params)
    assert turned and steps >= 4


def test_scheduled_job(spark, tmp_path):
    rows, frame = in_order(spark, 8, streams=2, n=120)
    where, spec, lr, capacity = paths(tmp_path), linear_model(2), 0.05, 3
    start_params = [0.9, -0.7, 0.2]
    deployed(spark, where, [0], start_params)
    members = spark.createDataFrame([(0, 0), (0, 1)], "model_id long, stream_id int")

    def start(stream):
        return streaming.scheduled_continual_job(
            stream, members, spec, win.WindowShape(2, 1, 1, 1), where, lr, capacity=capacity, seed=None, trigger=NOW
        )

    deliver(spark, frame, str(tmp_path / "in"), 4, start)
    params, memory, gates = np.array(start_params), {}, []
    for done in slices_of(rows, 4):
        g = slope(params, done)
        held = {s: list(v) for s, v in memory.items()}
        opened = False
        for s in (0, 1):
            rows_here = memory.get(s, []) + [w for w in done if w[0] == s]
            if not any(w[0] == s for w in done):
                continue
            sim = np.array([w[2].sum() / (np.linalg.norm(w[2]) * np.sqrt(2)) for w in rows_here])
            edges = np.linspace(sim.min(), sim.max(), capacity + 1)
            pick = [int(sim.argmin()), int(sim.argmax())]
            for i in range(1, capacity - 1):
                inside = [j for j in range(len(sim)) if edges[i] <= sim[j] < edges[i + 1]]
                if inside:
                    pick.append(min(inside, key=lambda j: rows_here[j][1]))
            candidate = [rows_here[j] for j in dict.fromkeys(pick)]
            if not memory.get(s) or np.var([w[2] for w in memory[s]]) < np.var([w[2] for w in candidate]):
                memory[s], opened = candidate, True
        gates.append(opened)
        if held and opened:
            g = project(g, np.array([slope(params, held[s]) for s in sorted(held)]))
        params = params - lr * g
    assert any(gates[1:])
    stored = VersionedTable(spark, f"{where.state}/params", "model_id long, params array<double>", ["model_id"])
    np.testing.assert_allclose(stored.read().first().params, params)
    kept = VersionedTable(spark, f"{where.state}/memory", "model_id long, stream_id int, k long", ["model_id", "stream_id"])
    assert {(r.stream_id, r.k) for r in kept.read().collect()} == {(s, w[1]) for s in memory for w in memory[s]}


def test_incremental_job(spark, tmp_path):
    rows, frame = in_order(spark, 9, n=160)
    where, spec, lr = paths(tmp_path), linear_model(2), 0.05
    deployed(spark, where, [0], [0.9, -0.7, 0.2])
    members = spark.createDataFrame([(0, s) for s in range(3)], "model_id long, stream_id int")
    cost = spark.createDataFrame([(0, 20.0, 600.0)], "model_id long, slope double, intercept double")

    def start(stream):
        return streaming.incremental_job(stream, members, spec, win.WindowShape(2, 1, 1, 1), cost, where, lr, trigger=NOW)

    deliver(spark, frame, str(tmp_path / "in"), 4, start)
    documents = read_results(spark, where.results).where("stream_id is not null")
    taken = documents.agg(F.sum(F.size("pred"))).first()[0]
    waiting = VersionedTable(spark, f"{where.state}/waiting", "model_id long, stream_id int, k long", ["model_id"], 1).read()
    done = [w for part in slices_of(rows, 4) for w in part]
    assert taken and taken + waiting.count() == len(done)
    losses = [r.loss for r in documents.groupBy("batch_id").agg(F.max("loss").alias("loss")).orderBy("batch_id").collect()]
    assert losses and all(v is not None for v in losses)
    errors = VersionedTable(spark, f"{where.state}/errors", "model_id long, errors array<double>", ["model_id"]).read().first().errors
    np.testing.assert_allclose(errors, ([0.3] * 6 + losses)[-6:])


def test_incremental_job_drains(spark, tmp_path):
    """Budgets follow each other until too few windows wait, also of a model whose streams have fallen silent."""
    rows, _ = in_order(spark, 21, streams=3, n=240)
    rows = [(0 if s == 2 else s, t, i, v) if i >= 80 else (s, t, i, v) for s, t, i, v in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    where, spec, lr = paths(tmp_path), linear_model(2), 0.05
    deployed(spark, where, [0, 1], [0.9, -0.7, 0.2])
    members = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (7, 0)], "model_id long, stream_id int")
    cost = spark.createDataFrame([(0, 20.0, 600.0), (1, 20.0, 600.0)], "model_id long, slope double, intercept double")
    shape, before = win.WindowShape(2, 1, 1, 1), []

    def start(stream):
        return streaming.incremental_job(stream, members, spec, shape, cost, where, lr, trigger=NOW)

    def seen(i):
        table = VersionedTable(spark, f"{where.state}/errors", "model_id long, at timestamp", ["model_id"])
        before.append({r.model_id: r.at for r in table.read().collect()})

    deliver(spark, frame, str(tmp_path / "in"), 3, start, seen)
    documents = read_results(spark, where.results).where("stream_id is not null").collect()
    waiting = VersionedTable(spark, f"{where.state}/waiting", "model_id long, stream_id int, k long, t_end timestamp, x array<double>, y array<double>", ["model_id"], 1).read().collect()
    windows = win.training_windows(frame, 2, 1, 1, 1).collect()
    for model, streams in ((0, (0, 1)), (1, (2,)), (7, (0,))):
        all_of = sorted((w.t_end, w.stream_id, w.k) for w in windows if w.stream_id in streams)
        left = sorted((w.t_end, w.stream_id, w.k) for w in waiting if w.model_id == model)
        done = sum(len(d.pred) for d in documents if d.model_id == model)
        assert done + len(left) == len(all_of) and left == all_of[len(all_of) - len(left) :]
    assert not [d for d in documents if d.model_id == 7]

    # replay: budgets from the losses, windows in order, predictions from before each training
    steps = {}
    for d in documents:
        steps.setdefault((d.model_id, d.batch_id), []).append(d)
    assert max(b % PER_BATCH for _, b in steps) > 0
    errors = VersionedTable(spark, f"{where.state}/errors", "model_id long, errors array<double>, rate double", ["model_id"]).read()
    errors = {r.model_id: r for r in errors.collect()}
    params = VersionedTable(spark, f"{where.state}/params", "model_id long, params array<double>", ["model_id"]).read()
    params = {r.model_id: r.params for r in params.collect()}
    for model, streams in ((0, (0, 1)), (1, (2,))):
        queue = sorted((w.t_end, w.stream_id, w.k, w.x, w.y) for w in windows if w.stream_id in streams)
        weights = np.array([0.9, -0.7, 0.2])
        for (_, batch), parts in sorted(i for i in steps.items() if i[0][0] == model):
            size = sum(len(d.pred) for d in parts)
            taken, queue = queue[:size], queue[size:]
            x = np.array([[*r[3], 1.0] for r in taken])
            y = np.array([r[4][0] for r in taken])
            for d in parts:
                np.testing.assert_allclose(d.pred, [v for v, r in zip(x @ weights, taken) if r[1] == d.stream_id], atol=1e-7)
            losses, moved = [], [weights]
            for _ in range(2000):
                losses.append(np.mean((x @ moved[-1] - y) ** 2))
                moved.append(moved[-1] - lr * 2 * x.T @ (x @ moved[-1] - y) / size)
            epochs = int(np.argmin(np.abs(np.array(losses) - parts[0].loss)))
            assert abs(losses[epochs] - parts[0].loss) < 1e-7
            weights = moved[epochs + 1]
        np.testing.assert_allclose(params[model], weights, atol=1e-6)
        held = [r for r in waiting if r.model_id == model]
        assert len(queue) == len(held)
        # fewer windows are left than the next budget asks for
        e = errors[model].errors
        slices_at = [b[model] for b in before if model in b]
        elapsed = (slices_at[-1] - (slices_at[-2] if len(slices_at) > 1 else START)).total_seconds()
        tick = [(model, errors[model].rate, max(elapsed, 1e-3), len(held), e[-1], sum(e[:5]) / 5)]
        ticks = spark.createDataFrame(tick, "model_id long, rate double, elapsed double, backlog long, error double, recent_error double")
        assert len(held) < batching.training_budget(ticks, cost).first().batch_size


@pytest.mark.parametrize("method", ["grid", "real"])
def test_drained_budgets(spark, method):
    """Budgets far smaller and far larger than a block of sums, against epochs taken one by one on the windows."""
    from onlinecast.streaming.budgets import BLOCK, drained

    rng = np.random.default_rng(12)
    spec, lr, start = linear_model(3, outputs=2), 0.05, np.linspace(-0.4, 0.5, 8)
    settings = {1: (2.0, 40.0, 0.4, 30.0), 2: (0.05, 900.0, 3.0, 20.0), 3: (400.0, 30.0, 0.002, 9.0)}
    rows, sizes = [], {1: 1700, 2: 900, 3: 6000, 9: 5}
    for model, n in sizes.items():
        for i in range(n):
            x = rng.normal(size=3) * (1 + i / n)
            y = [x @ [0.3, -0.2, 0.6] + rng.normal() * 0.3, x[0] - rng.normal() * 0.2]
            rows.append((model, int(rng.integers(3)), i, START + dt.timedelta(seconds=i), x.tolist(), [float(v) for v in y]))
    kind = "model_id long, stream_id int, k long, t_end timestamp, x array<double>, y array<double>"
    states = [(m, start.tolist(), [], [], 10000.0, [0.3] * 6, *settings[m]) for m in settings]
    states = spark.createDataFrame(states, "model_id long, params array<double>, sizes array<long>, losses array<double>, best double, "
                                   "errors array<double>, rate double, elapsed double, slope double, intercept double")
    done = drained(spark.createDataFrame(rows, kind).repartition(7), states, spec, lr, method)
    steps = {(r.model_id, r.step): r for r in done.steps.collect()}
    taken = {(r.model_id, r.k): r for r in done.taken.collect()}
    models = {r.model_id: r for r in done.models.collect()}
    waiting = {(r.model_id, r.k) for r in done.waiting.collect()}
    assert waiting >= {(9, k) for k in range(5)} and len(waiting) + len(taken) == len(rows)
    most = 0
    for m, (rate, elapsed, slope, intercept) in settings.items():
        mine = [r for r in rows if r[0] == m]
        params, errors, at, step = start, [0.3] * 6, 0, 0
        queue, best = [], 10000.0
        while True:
            epochs, size = batching.one_budget(rate, elapsed, slope, intercept, errors[-1], sum(errors[:5]) / 5, method)
            if at + size > len(mine):
                break
            x = np.array([[*r[4], 1.0] for r in mine[at : at + size]])
            y = np.array([r[5] for r in mine[at : at + size]])
            weights = params.reshape(2, 4)
            for r, p in zip(mine[at : at + size], x @ weights.T):
                got = taken[m, r[2]]
                assert got.step == step
                np.testing.assert_allclose(got.pred, p, atol=1e-7)
            for _ in range(epochs):
                miss = x @ weights.T - y
                weights = weights - lr * 2 * miss.T @ x / y.size
            loss, params = float((miss * miss).mean()), weights.ravel()
            queue.append((size, loss))
            publish = False
            if sum(n for n, _ in queue) >= 288:
                mean = np.mean([v for _, v in queue])
                publish = mean < best
                best = min(best, mean)
                queue.pop(0)
            done_step = steps[m, step]
            assert (done_step.size, done_step.epochs, done_step.start, done_step.publish) == (size, epochs, at, publish)
            np.testing.assert_allclose(done_step.loss, loss, rtol=1e-6, atol=1e-10)
            errors, at, step, most = [*errors, loss][-6:], at + size, step + 1, max(most, size)
        assert models[m].step == step and models[m].start == at
        np.testing.assert_allclose(models[m].params, params, atol=1e-6)
        np.testing.assert_allclose(models[m].errors, errors, rtol=1e-6)
        assert {k for model, k in waiting if model == m} == set(range(at, len(mine)))
    assert len(steps) > 20 and most > BLOCK


@pytest.mark.parametrize("method", ["grid", "real"])
def test_one_budget(spark, method):
    from onlinecast.operators.batching import one_budget

    rng = np.random.default_rng(4)
    rows = [(k, *(float(v) for v in np.exp(rng.normal(0, 2, 3))), int(rng.integers(9)), *(float(v) for v in np.exp(rng.normal(0, 2, 2)))) for k in range(300)]
    ticks = spark.createDataFrame([(k, r, t, b, e, m) for k, r, t, _, b, e, m in rows], "model_id long, rate double, elapsed double, backlog long, error double, recent_error double")
    cost = spark.createDataFrame([(k, 0.3 * (k % 7 + 1), f - 0.2) for k, _, _, f, *_ in rows], "model_id long, slope double, intercept double")
    prices = {r.model_id: r for r in cost.collect()}
    want = {r.model_id: (r.epochs, r.batch_size) for r in batching.training_budget(ticks, cost, method).collect()}
    for k, rate, elapsed, _, _, error, recent in rows:
        assert one_budget(rate, elapsed, prices[k].slope, prices[k].intercept, error, recent, method) == want[k]


def test_publication(spark, tmp_path):
    """Once 288 rows are queued, a model whose mean loss is the best so far becomes a new version."""
    rows, frame = in_order(spark, 10, streams=1, n=700)
    where, spec = paths(tmp_path), linear_model(2)
    deployed(spark, where, [0], [0.9, -0.7, 0.2])
    members = spark.createDataFrame([(0, 0)], "model_id long, stream_id int")

    def start(stream):
        return streaming.continual_job(
            stream, members, spec, win.WindowShape(2, 1, 1, 1), where, 0.05, projection="average", capacity=5, trigger=NOW
        )

    deliver(spark, frame, str(tmp_path / "in"), 4, start)
    losses = [r.loss for r in read_results(spark, where.results).where("stream_id is not null").orderBy("batch_id").collect()]
    sizes = [len(p) for p in slices_of(rows, 4)]
    queue, best, published = [], 10000.0, []
    for b, pair in enumerate(zip(sizes, losses)):
        queue.append(pair)
        if sum(n for n, _ in queue) >= 288:
            mean = np.mean([v for _, v in queue])
            queue.pop(0)
            if mean < best:
                best = mean
                published.append((b, losses[b]))
    assert published
    versions = read_registry(spark, where.registry).orderBy("version").collect()
    assert [r.version for r in versions] == list(range(1, len(published) + 2))
    np.testing.assert_allclose([r.loss for r in versions], [100.0] + [v for _, v in published])
    markers = read_results(spark, where.results).where("stream_id is null").orderBy("batch_id").collect()
    assert [r.batch_id for r in markers] == [b for b, _ in published]


def test_summary_job(spark, tmp_path):
    """The running summary equals the batch one after each part, also when a part is written or read again."""
    where = paths(tmp_path)
    rows = [(i % 3, i // 3, i, i % 2, [0.1 * i, -1.0], [0.2 * (40 - i), 0.0], float(i % 7) if i % 5 else None) for i in range(60)]
    kind = "model_id long, seq long, batch_id long, stream_id int, pred array<double>, true array<double>, loss double"
    results = spark.createDataFrame(rows, kind).withColumn("average_loss", F.col("loss") / 2)
    columns = ["model_id", "documents", "max_value", "max_loss", "max_average_loss"]
    known = {}
    for i, upto in enumerate((7, 7, 12, 20)):
        run = max(i, 1)  # the second part is the first one written again
        first = 0 if i < 2 else (7, 12)[i - 2]
        append_results(results.where((F.col("seq") >= first) & (F.col("seq") < upto)), where.results, run)
        streaming.summary_job(spark, where, NOW).awaitTermination()
        if i == 2:
            replay_last(where)
            streaming.summary_job(spark, where, NOW).awaitTermination()
        found = streaming.read_summary(spark, where)
        same(found.select(*columns), analytics.axis_maxima(results.where(F.col("seq") < upto)).select(*columns))
        new = {r.model_id: r.new_documents for r in found.collect()}
        assert new == {m: upto - known.get(m, 0) for m in range(3)}
        known = {m: upto for m in range(3)}


def test_state_survives_compaction(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], compact=3)
    want, before = {}, {}
    for b in range(10):
        before = dict(want)
        rows = [(k, 100 * b + k) for k in range(5) if (k + b) % 3 == 0]
        want |= dict(rows)
        table.write(spark.createDataFrame(rows, "k int, v int"), b)
        table.write(spark.createDataFrame(rows, "k int, v int"), b)
        assert {r.k: r.v for r in table.read(b + 1).collect()} == want
    assert {r.k: r.v for r in table.read(9).collect()} == before


def test_hot_stream_in_a_stream(spark, tmp_path):
    frame = readings(spark, 3, hot=200, others=2)
    out = str(tmp_path / "w")
    frame.write.parquet(out + "-in")
    rows = spark.readStream.schema(SCHEMA).parquet(out + "-in")
    writer = streaming.lookback_windows_stream(rows, 5).writeStream.format("parquet").option("checkpointLocation", out + "-c")
    writer.trigger(**NOW).start(out).awaitTermination()
    same(spark.read.parquet(out), win.lookback_windows(frame, 5))


def test_two_jobs_share_a_registry(spark, tmp_path):
    """No job erases what another published, nor a restarted one what it did before; a replay replaces itself."""
    path = str(tmp_path / "registry")
    kind = "model_id long, update_time timestamp, loss double, params array<double>"

    def publish(model, loss, run, job):
        append_registry(spark.createDataFrame([(model, START, loss, [loss])], kind), path, run, job)

    rows = spark.createDataFrame([(m, START, [0.0]) for m in (1, 2)], "model_id long, create_time timestamp, params array<double>")
    deploy(rows, path)
    deploy(rows, path)
    publish(1, 0.5, 0, "a")
    publish(2, 0.6, 0, "b")
    publish(1, 0.4, 1, "a")
    publish(1, 0.3, 1, "a")
    publish(1, 0.2, 0, JobPaths("s", "new checkpoint", "r", "o").job)
    found = sorted((r.model_id, r.version, r.loss) for r in read_registry(spark, path).collect())
    assert found == [(1, 1, 100.0), (1, 2, 0.5), (1, 3, 0.3), (1, 4, 0.2), (2, 1, 100.0), (2, 2, 0.6)]


def test_folders_of_state_and_lineage_are_bounded(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "k int, v int", ["k"], compact=4)
    for b in range(30):
        table.write(spark.createDataFrame([(b % 3, b)], "k int, v int"), b)
        assert len(table._versions()) <= 2 * 4 + 1
    assert {r.k: r.v for r in table.read(30).collect()} == {0: 27, 1: 28, 2: 29}
    assert {r.k: r.v for r in table.read(29).collect()} == {0: 27, 1: 28, 2: 26}
    with tables.passing_tables(spark):
        first = tables.written(spark.range(3), "passing")
        assert first.count() == 3
        path = first.inputFiles()[0].rsplit("/", 1)[0]
    assert not tables.exists(spark, path)


def test_windows_by_topic(spark, tmp_path):
    rows, frame = in_order(spark, 11, n=60)
    windows = win.lookback_windows(frame, 3).withColumn("model_id", F.col("stream_id") % 2)
    to = F.concat(F.lit("model"), F.col("model_id").cast("string"), F.lit("-infer"))
    out = str(tmp_path / "w")
    write_windows(windows, "parquet", {"path": out}, topics=to)
    found = {r.window_topic: r["count"] for r in spark.read.parquet(out).groupBy("window_topic").count().collect()}
    want = {f"model{r.model_id}-infer": r["count"] for r in windows.groupBy("model_id").count().collect()}
    assert found == want


def test_model_windows_without_subscriptions(spark):
    _, frame = in_order(spark, 12, n=30)
    kind = "model_id long, stream_id int, look_back int, shift int, forward_step int, forward_size int"
    assert win.model_windows(frame, spark.createDataFrame([], kind)).count() == 0


def test_all_steps_at_once(spark):
    """Steps of all turns from sums of products against steps one by one; old memory is partly newer than what arrives."""
    from onlinecast.streaming.turns import stepped

    rng, spec, lr, capacity = np.random.default_rng(3), linear_model(2), 0.05, 3
    schema = "model_id long, stream_id int, k long, t_end timestamp, x array<double>, y array<double>, turn long"

    def row(s, k, second, turn):
        return (0, s, k, START + dt.timedelta(seconds=second), rng.normal(size=2).tolist(), rng.normal(size=1).tolist(), turn)

    old = [row(0, 0, 1, -1), row(0, 1, 30, -1), row(2, 0, 2, -1)]
    new = [row(int(rng.integers(0, 2)), 2 + i, 5 + i, i // 4) for i in range(40)]
    memory, windows = (spark.createDataFrame(r, schema) for r in (old, new))
    before = spark.createDataFrame([(0, [0.9, -0.7, 0.2])], "model_id long, params array<double>")
    got = {r.turn: r for r in stepped(windows, memory.drop("turn"), before, spec, lr, capacity).collect()}
    assert sorted(got) == list(range(10))

    def mean_slope(params, rows):
        return slope(params, [(r[1], r[2], np.array(r[4]), np.array(r[5])) for r in rows])

    params, turned = np.array([0.9, -0.7, 0.2]), 0
    for turn in range(10):
        np.testing.assert_allclose(got[turn].params, params)
        come = [r for r in old + new if r[6] < turn]
        held = [sorted((r for r in come if r[1] == s), key=lambda r: r[3])[-capacity:] for s in (0, 1, 2)]
        g = mean_slope(params, [r for r in new if r[6] == turn])
        mean = np.mean([mean_slope(params, rows) for rows in held if rows], axis=0)
        if g @ mean < 0:
            g, turned = g - (g @ mean) / (mean @ mean) * mean, turned + 1
        params = params - lr * g
        np.testing.assert_allclose(got[turn].moved, params)
    assert turned
