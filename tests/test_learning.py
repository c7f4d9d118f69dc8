"""Learning operators against numpy."""

import datetime as dt
import math

import numpy as np
import pytest

from onlinecast.operators import batching, learning, memory, promotion
from onlinecast.operators.models import ModelSpec, linear_model, mlp_model, register_model, registered_model
from onlinecast.operators.scoring import score

START = dt.datetime(2024, 1, 1)


def coordinate_descent(matrix, linear, bound, rounds=20_000):
    """Plain minimum of v'Av/2 + b'v over v >= bound."""
    v = np.full(len(linear), bound)
    for _ in range(rounds):
        before = v.copy()
        for i in range(len(v)):
            v[i] = max(bound, v[i] - (matrix[i] @ v + linear[i]) / matrix[i, i])
        if np.abs(v - before).max() < 1e-14:
            break
    return v


def project(g, memories, margin=0.5, ridge=1e-3):
    if not (memories @ g < 0).any():
        return g
    matrix = memories @ memories.T + ridge * np.eye(len(memories))
    return g + coordinate_descent(matrix, memories @ g, margin) @ memories


def grad_frames(spark, cases):
    current = [(m, p, float(v)) for m, (g, _) in enumerate(cases) for p, v in enumerate(g)]
    mems = [(m, s, p, float(v)) for m, (_, mem) in enumerate(cases) for s, row in enumerate(mem) for p, v in enumerate(row)]
    return (
        spark.createDataFrame(current, "model_id long, p int, g double"),
        spark.createDataFrame(mems, "model_id long, stream_id int, p int, g double"),
    )


def window_frame(spark, rows):
    """rows: (model, stream, k, x, y)."""
    data = [(m, s, k, START + dt.timedelta(seconds=k), [float(v) for v in x], [float(v) for v in y]) for m, s, k, x, y in rows]
    return spark.createDataFrame(data, "model_id long, stream_id int, k long, t_end timestamp, x array<double>, y array<double>")


def random_windows(spark, rng, n=60, wide=3, outs=1, models=2):
    rows = [(int(rng.integers(models)), int(rng.integers(5)), k, rng.normal(size=wide), rng.normal(size=outs)) for k in range(n)]
    return rows, window_frame(spark, rows)


@pytest.mark.parametrize("seed", range(25))
def test_bounded_minimum_is_optimal(seed):
    rng = np.random.default_rng(seed)
    t = int(rng.integers(1, 15))
    m = rng.normal(size=(t, int(rng.integers(1, 20)))) * 10.0 ** rng.integers(-2, 3)
    matrix, linear = m @ m.T + 1e-3 * np.eye(t), m @ rng.normal(size=m.shape[1])
    v = learning.bounded_minimum(matrix, linear, 0.5)
    slope = matrix @ v + linear
    scale = np.abs(matrix).max() + np.abs(linear).max()
    assert (v >= 0.5).all()
    assert (slope >= -1e-8 * scale).all()
    assert np.abs(slope * (v - 0.5)).max() <= 1e-7 * scale * max(1, v.max())


def test_exact_projection(spark, monkeypatch):
    monkeypatch.setattr(learning, "GRAM_BLOCK", 4)
    rng = np.random.default_rng(1)
    cases = [(rng.normal(size=11), rng.normal(size=(t, 11))) for t in (1, 2, 4, 7)]
    cases.append((np.ones(11), np.ones((3, 11))))
    current, mems = grad_frames(spark, cases)
    got = {(r.model_id, r.p): r.g for r in learning.project_gradient(current, mems).collect()}
    for m, (g, mem) in enumerate(cases):
        np.testing.assert_allclose([got[m, p] for p in range(11)], project(g, mem), rtol=1e-6, atol=1e-8)


def test_average_projection(spark):
    rng = np.random.default_rng(2)
    cases = [(rng.normal(size=5), rng.normal(size=(3, 5))) for _ in range(6)]
    current, mems = grad_frames(spark, cases)
    got = {(r.model_id, r.p): r.g for r in learning.project_gradient(current, mems, method="average").collect()}
    for m, (g, mem) in enumerate(cases):
        mean = mem.mean(0)
        want = g - min(0, g @ mean) / (mean @ mean) * mean
        np.testing.assert_allclose([got[m, p] for p in range(5)], want)
        assert want @ mean >= -1e-12


def test_exact_projection_by_parameters(spark, monkeypatch):
    monkeypatch.setattr(learning, "GRAM_STREAMS", 0)
    rng = np.random.default_rng(1)
    cases = [(rng.normal(size=6), rng.normal(size=(t, 6))) for t in (1, 2, 4, 9)]
    cases.append((np.ones(6), np.ones((3, 6))))
    current, mems = grad_frames(spark, cases)
    got = {(r.model_id, r.p): r.g for r in learning.project_gradient(current, mems).collect()}
    for m, (g, mem) in enumerate(cases):
        np.testing.assert_allclose([got[m, p] for p in range(6)], project(g, mem), rtol=1e-5, atol=1e-7)


def test_exact_projection_of_many_streams(spark):
    rng = np.random.default_rng(3)
    g, mem = rng.normal(size=4), rng.normal(size=(learning.GRAM_STREAMS + 76, 4))
    current, mems = grad_frames(spark, [(g, mem)])
    got = {r.p: r.g for r in learning.project_gradient(current, mems).collect()}
    turned = np.array([got[p] for p in range(4)])
    v = np.maximum(0.5, -(mem @ turned) / 1e-3)
    np.testing.assert_allclose(turned, g + v @ mem, rtol=1e-6, atol=1e-6)


def test_exact_projection_settles_whatever_the_streams(spark):
    """Equal streams, streams of any size and gradients far from the solution; a residual is only as small as rounding lets it."""
    rng = np.random.default_rng(8)
    cases = []
    for size in (0.1, 1.0, 100.0):
        mem = rng.normal(size=(1500, 3)) * size
        cases += [(rng.normal(size=3), m) for m in (mem, np.repeat(mem[:300], 5, axis=0), mem * 10.0 ** rng.uniform(-2, 2, size=(1500, 1)))]
    current, mems = grad_frames(spark, cases)
    got = {(r.model_id, r.p): r.g for r in learning.project_gradient(current, mems).collect()}
    for m, (g, mem) in enumerate(cases):
        turned = np.array([got[m, p] for p in range(3)])
        v = np.maximum(0.5, -(mem @ turned) / 1e-3)
        assert np.abs(turned - g - v @ mem).max() <= 1e-6 * np.abs(v[:, None] * mem).sum(axis=0).max()
        free = v > 0.5
        again = np.linalg.solve(mem[free].T @ mem[free] + 1e-3 * np.eye(3), 1e-3 * (g + 0.5 * mem[~free].sum(axis=0)))
        np.testing.assert_allclose(turned, again, rtol=1e-6)


@pytest.mark.parametrize("loss", ["mse", "mae"])
@pytest.mark.parametrize("outs", [1, 2])
def test_linear_gradient(spark, loss, outs):
    rng = np.random.default_rng(3)
    spec = linear_model(3, outs, loss)
    params = rng.normal(size=spec.size)
    rows, frame = random_windows(spark, rng, outs=outs)
    got = {(r.model_id, r.p): r.g for r in learning.gradient(frame, list(params), spec).collect()}
    for m in (0, 1):
        x = np.array([r[3] for r in rows if r[0] == m])
        y = np.array([r[4] for r in rows if r[0] == m])
        x1 = np.hstack([x, np.ones((len(x), 1))])
        miss = x1 @ params.reshape(outs, 4).T - y
        out = 2 * miss if loss == "mse" else np.sign(miss)
        want = (out.T @ x1 / miss.size).ravel()
        np.testing.assert_allclose([got[m, p] for p in range(spec.size)], want)


def test_mlp_gradient_is_the_slope_of_its_loss(spark):
    rng = np.random.default_rng(4)
    spec = mlp_model(3, 4, outputs=2)
    rows, frame = random_windows(spark, rng, outs=2, models=1)
    params = np.array(spec.init)
    got = [r.g for r in learning.gradient(frame, list(params), spec).orderBy("p").collect()]
    x, y = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])

    def mean_loss(p):
        return ((spec.predict(p, x) - y) ** 2).mean()

    for i in rng.choice(len(params), 8, replace=False):
        step = np.zeros(len(params))
        step[i] = 1e-6
        slope = (mean_loss(params + step) - mean_loss(params - step)) / 2e-6
        assert math.isclose(got[i], slope, rel_tol=1e-4, abs_tol=1e-7)
    by_stream = learning.memory_gradients(frame, list(params), spec)
    sizes = {s: sum(r[1] == s for r in rows) for s in range(5)}
    total = np.zeros(len(params))
    for r in by_stream.collect():
        total[r.p] += r.g * sizes[r.stream_id] / len(rows)
    np.testing.assert_allclose(total, got, atol=1e-12)


@pytest.mark.parametrize("loss,outs", [("mse", 1), ("mse", 2), ("mae", 1)])
def test_fit_epochs(spark, loss, outs):
    rng = np.random.default_rng(5)
    spec = linear_model(3, outs, loss)
    rows, frame = random_windows(spark, rng, outs=outs)
    starts = {0: rng.normal(size=spec.size), 1: rng.normal(size=spec.size), 7: np.ones(spec.size)}
    epochs = {0: 4, 1: 2, 7: 3}
    params = spark.createDataFrame(
        [(m, [float(v) for v in w], epochs[m]) for m, w in starts.items()], "model_id long, params array<double>, epochs int"
    )
    fitted = {r.model_id: r for r in learning.fit_epochs(frame, params, spec, "epochs", 0.1).collect()}
    for m, w in starts.items():
        x = np.array([r[3] for r in rows if r[0] == m])
        if not len(x):
            np.testing.assert_allclose(fitted[m].params, w)
            assert fitted[m].loss is None
            continue
        y = np.array([r[4] for r in rows if r[0] == m])
        x1 = np.hstack([x, np.ones((len(x), 1))])
        for _ in range(epochs[m]):
            miss = x1 @ w.reshape(outs, 4).T - y
            last = (miss**2).mean() if loss == "mse" else np.abs(miss).mean()
            out = 2 * miss if loss == "mse" else np.sign(miss)
            w = w - 0.1 * (out.T @ x1 / miss.size).ravel()
        np.testing.assert_allclose(fitted[m].params, w)
        assert math.isclose(fitted[m].loss, last)


@pytest.mark.parametrize("optimizer", ["sgd", "momentum", "adam"])
def test_optimizers(spark, optimizer):
    rng = np.random.default_rng(6)
    w, m, v = rng.normal(size=3), np.zeros(3), np.zeros(3)
    state = spark.createDataFrame([(0, w.tolist()), (1, [9.0, 9.0, 9.0])], "model_id long, params array<double>")
    for t in range(1, 4):
        g = rng.normal(size=3)
        grads = spark.createDataFrame([(0, p, float(x)) for p, x in enumerate(g)], "model_id long, p int, g double")
        state = learning.apply_update(state, grads, 0.1, optimizer)
        if optimizer == "sgd":
            w = w - 0.1 * g
        elif optimizer == "momentum":
            m = 0.9 * m + g
            w = w - 0.1 * m
        else:
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 0.1 * math.sqrt(1 - 0.999**t) / (1 - 0.9**t) * m / (np.sqrt(v) + 1e-7)
    got = {r.model_id: r.params for r in state.collect()}
    np.testing.assert_allclose(got[0], w)
    assert got[1] == [9.0, 9.0, 9.0]


def test_ring_reset_steps(spark):
    rng = np.random.default_rng(7)
    rows, k = [], 0
    for batch in range(40):
        for stream in range(3):
            for _ in range(int(rng.integers(0, 4))):
                rows.append((0, stream, k, batch, START + dt.timedelta(seconds=k), [float(k)], [0.0]))
                k += 1
    frame = spark.createDataFrame(
        rows, "model_id long, stream_id int, k long, batch_id long, t_end timestamp, x array<double>, y array<double>"
    )
    for capacity in (4, 9, 50):
        want = []
        for stream in range(3):
            stored = []
            for batch in range(40):
                new = [r[2] for r in rows if r[1] == stream and r[3] == batch]
                if len(stored) + len(new) >= capacity:
                    stored = []
                else:
                    stored += new
            want += stored
        got = sorted(r.k for r in memory.ring_memory_reset(frame, capacity).collect())
        assert got == sorted(want)


def test_similarity_memory(spark):
    rng = np.random.default_rng(8)
    rows = [(0, int(s), k, rng.normal(1, 1, 4), [0.0]) for k, s in enumerate(rng.integers(0, 4, 200))]
    rows += [(0, 9, 500, np.zeros(4), [0.0]), (0, 10, 501, np.ones(4), [0.0]), (0, 10, 502, np.ones(4), [0.0])]
    frame = window_frame(spark, rows)
    capacity = 6
    first = memory.similarity_memory(None, frame, capacity, seed=3).collect()
    again = memory.similarity_memory(None, frame, capacity, seed=3).collect()
    assert {(r.stream_id, r.k) for r in first} == {(r.stream_id, r.k) for r in again}
    other = memory.similarity_memory(None, frame, capacity, seed=4).collect()
    assert {(r.stream_id, r.k) for r in first} != {(r.stream_id, r.k) for r in other}
    for stream in range(4):
        mine = [r for r in rows if r[1] == stream]
        s = np.array([r[3].sum() / (np.linalg.norm(r[3]) * 2) for r in mine])
        edges = np.linspace(s.min(), s.max(), capacity + 1)
        kept = {r.k for r in first if r.stream_id == stream}
        assert len(kept) <= capacity
        assert mine[int(s.argmin())][2] in kept and mine[int(s.argmax())][2] in kept
        for i in range(1, capacity - 1):
            inside = {r[2] for r, v in zip(mine, s) if edges[i] <= v < edges[i + 1]}
            assert len(inside & kept) == (1 if inside else 0)
    assert [r.k for r in first if r.stream_id == 9] == [500]
    assert [r.k for r in first if r.stream_id == 10] == [501]
    with pytest.raises(ValueError):
        memory.similarity_memory(None, frame, 1)


def test_variance_gate(spark):
    low = window_frame(spark, [(0, 1, 0, [1, 1], [0]), (0, 1, 1, [1, 2], [0]), (0, 2, 0, [0, 9], [0])])
    high = window_frame(spark, [(0, 1, 5, [0, 9], [0]), (0, 2, 6, [1, 1], [0]), (0, 3, 7, [1, 1], [0])])
    gate = memory.variance_gate(low, high)
    assert {r.stream_id: r.accepted for r in gate.collect()} == {1: True, 2: False, 3: True}
    strict = memory.variance_gate(low, high, empty_accepts=False)
    assert {r.stream_id: r.accepted for r in strict.collect()} == {1: True, 2: False, 3: False}
    merged = {(r.stream_id, r.k) for r in memory.gated_memory(low, high, gate).collect()}
    assert merged == {(1, 5), (2, 0), (3, 7)}


def test_promotion_steps(spark):
    rng = np.random.default_rng(9)
    rows = [(m, b, int(rng.choice([1, 5, 40, 100, 300])), float(rng.random())) for m in (0, 1) for b in range(300)]
    frame = spark.createDataFrame(rows, "model_id long, batch_id long, rows int, loss double")
    got = {(r.model_id, r.batch_id): (r.mean_loss, r.publish) for r in promotion.promotion_gate(frame).collect()}
    for m in (0, 1):
        queue, best = [], 10000.0
        for _, b, n, loss in (r for r in rows if r[0] == m):
            queue.append((n, loss))
            mean, publish = None, False
            if sum(q[0] for q in queue) >= 288:
                mean = np.mean([q[1] for q in queue])
                queue.pop(0)
                publish = mean < best
                best = min(best, mean)
            assert got[m, b][1] == publish
            assert (mean is None) == (got[m, b][0] is None)
            assert mean is None or math.isclose(mean, got[m, b][0])


@pytest.mark.parametrize("size", [1, 7, 32, 288, 500])
def test_promotion_with_equal_batches(spark, size):
    rng = np.random.default_rng(size)
    rows = [(0, b, size, float(rng.random())) for b in range(320)]
    frame = spark.createDataFrame(rows, "model_id long, batch_id long, rows int, loss double")
    plain = {r.batch_id: (r.mean_loss, r.publish) for r in promotion.promotion_gate(frame).collect()}
    quick = {r.batch_id: (r.mean_loss, r.publish) for r in promotion.promotion_gate(frame, batch_size=size).collect()}
    for b in plain:
        assert plain[b][1] == quick[b][1]
        assert (plain[b][0] is None) == (quick[b][0] is None)
        assert plain[b][0] is None or math.isclose(plain[b][0], quick[b][0])


def test_fit_of_wide_windows(spark):
    """Windows of 336 readings: one pass, any number of epochs, a row a model and task."""
    rng = np.random.default_rng(8)
    spec, n, lr = linear_model(336, outputs=2), 300, 0.001
    x, y = rng.normal(size=(2 * n, 336)), rng.normal(size=(2 * n, 2))
    frame = window_frame(spark, [(i % 2, 0, i, x[i].tolist(), y[i].tolist()) for i in range(2 * n)]).repartition(5)
    start = rng.normal(size=2 * 337) * 0.1
    params = spark.createDataFrame([(m, start.tolist(), 3 + 9 * m) for m in (0, 1, 2)], "model_id long, params array<double>, e int")
    got = {r.model_id: r for r in learning.fit_epochs(frame, params, spec, "e", lr).collect()}
    for m in (0, 1):
        wide, target, weights = np.hstack([x[m::2], np.ones((n, 1))]), y[m::2], start.reshape(2, 337)
        for _ in range(3 + 9 * m):
            miss = wide @ weights.T - target
            weights = weights - lr * 2 * miss.T @ wide / target.size
        np.testing.assert_allclose(got[m].params, weights.ravel(), atol=1e-9)
        np.testing.assert_allclose(got[m].loss, (miss * miss).mean())
    assert got[2].params == start.tolist() and got[2].loss is None


def budget_frames(spark, seed, n=60):
    rng = np.random.default_rng(seed)
    costs = [(m, float(10 ** rng.uniform(-4, -2)), float(10 ** rng.uniform(-2, 1.5))) for m in range(n)]
    ticks = [
        (m, 0, float(10 ** rng.uniform(-1, 2)), float(rng.uniform(1, 60)), 10, float(rng.uniform(0.05, 1)), float(rng.uniform(0.05, 1)))
        for m in range(n)
    ]
    return (
        ticks,
        costs,
        spark.createDataFrame(ticks, "model_id long, tick long, rate double, elapsed double, backlog long, error double, recent_error double"),
        spark.createDataFrame(costs, "model_id long, slope double, intercept double"),
    )


def rows_for(e, ld, b, b1, ratio):
    roots = np.roots([1, ld * (b * e - b1), 0, -ld * 60000 * ratio / e])
    real = roots[np.abs(roots.imag) < 1e-6 * np.maximum(1, np.abs(roots))].real
    return real[real > 0].max()


def test_budget_grid_is_the_best_choice(spark):
    ticks, costs, frame, cost = budget_frames(spark, 0)
    got = {r.model_id: r for r in batching.training_budget(frame, cost).collect()}
    inner = 0
    for (m, _, ld, t, backlog, err, recent), (_, b, b1) in zip(ticks, costs):
        if 1 - b * ld != 0:
            t = max(t, b1 / (1 - b * ld))
        top, ratio = (t - b1) / (b * ld * t), err / recent
        choices = [1.0] if top < 1 else [*map(float, range(1, int(top) + 1)), top]

        def weigh(e):
            d = rows_for(e, ld, b, b1, ratio)
            return d * d / (2 * ld) + b * d * e - b1 * d + 60000 * ratio / (e * d)

        best = min(choices, key=weigh)
        inner += 1 < best < int(top)
        size = max(1, math.floor(rows_for(best, ld, b, b1, ratio)))
        assert got[m].epochs == max(1, math.floor(best))
        assert got[m].batch_size == size
        assert math.isclose(got[m].wait_seconds, max(0, (size - backlog) / ld), abs_tol=1e-9)
    assert inner > 0


def test_budget_over_real_epochs_is_the_least_cost(spark):
    ticks, costs, frame, cost = budget_frames(spark, 1, 12)
    got = {r.model_id: r for r in batching.training_budget(frame, cost, "real").collect()}
    for (m, _, ld, t, backlog, err, recent), (_, b, b1) in zip(ticks, costs):
        if 1 - b * ld != 0:
            t = max(t, b1 / (1 - b * ld))
        top, ratio = (t - b1) / (b * ld * t), err / recent

        def weigh(e):
            d = rows_for(e, ld, b, b1, ratio)
            return d * d / (2 * ld) + b * d * e - b1 * d + 60000 * ratio / (e * d)

        grid = np.linspace(1.0, max(top, 1.0), 400)
        best = grid[int(np.argmin([weigh(e) for e in grid]))]
        width = (max(top, 1.0) - 1) / 399
        assert best - width - 1 <= got[m].epochs <= best + width


def test_budget_of_many_settings(spark):
    """Least cost over all whole epochs and all rows, small errors and cubics of three real roots included."""
    rng = np.random.default_rng(6)
    n = 5000
    slope, intercept = 10 ** rng.uniform(-4, 1.5, n), 10 ** rng.uniform(-3, 2, n)
    rate, elapsed = 10 ** rng.uniform(-3, 2, n), 10 ** rng.uniform(0, 4, n)
    error, recent = 10 ** rng.uniform(-9, 0, n), 10 ** rng.uniform(-2, 0, n)
    slope = np.maximum(slope, 1 / (rate * 5000))  # at most some thousand epochs to try
    ticks = [(int(k), 0, float(rate[k]), float(elapsed[k]), 10, float(error[k]), float(recent[k])) for k in range(n)]
    frame = spark.createDataFrame(ticks, "model_id long, tick long, rate double, elapsed double, backlog long, error double, recent_error double")
    cost = spark.createDataFrame([(int(k), float(slope[k]), float(intercept[k])) for k in range(n)], "model_id long, slope double, intercept double")
    got = {r.model_id: r for r in batching.training_budget(frame, cost).collect()}
    three = 0
    for k in range(n):
        waited = elapsed[k]
        if 1 - slope[k] * rate[k] != 0:
            waited = max(waited, intercept[k] / (1 - slope[k] * rate[k]))
        top, ratio = (waited - intercept[k]) / (slope[k] * rate[k] * waited), error[k] / recent[k]
        e = np.array([1.0]) if top < 1 else np.append(np.arange(1.0, math.floor(top) + 1), top)
        # the slope of the cost over rows rises through 0 once: halve the interval
        b, c = rate[k] * (slope[k] * e - intercept[k]), rate[k] * 60000 * ratio / e
        low, high = np.zeros(len(e)), np.abs(b) + np.cbrt(c)
        for _ in range(200):
            middle = (low + high) / 2
            above = middle * middle * (middle + b) > c
            low, high = np.where(above, low, middle), np.where(above, middle, high)
        d = (low + high) / 2
        weights = d * d / (2 * rate[k]) + slope[k] * d * e - intercept[k] * d + 60000 * ratio / (e * d)
        best = int(weights.argmin())
        three += (c[best] / 2 - b[best] ** 3 / 27) ** 2 <= (b[best] / 3) ** 6
        near = np.flatnonzero(weights <= weights[best] + 1e-9 * abs(weights[best]))
        right = {(max(1, math.floor(e[i])), max(1, math.floor(d[i] * (1 + s)))) for i in near for s in (-1e-9, 1e-9)}
        assert (got[k].epochs, got[k].batch_size) in right
        assert batching.one_budget(rate[k], elapsed[k], slope[k], intercept[k], error[k], recent[k]) in right
    assert three > 500


def test_budget_without_error(spark):
    """An error of 0 asks for the least training; after recent errors of 0 the error counts as equal to them."""
    kind = "model_id long, tick long, rate double, elapsed double, backlog long, error double, recent_error double"
    frame = spark.createDataFrame([(1, 0, 0.1, 50.0, 3, 0.0, 0.2), (2, 0, 0.1, 50.0, 3, 0.3, 0.0), (3, 0, 0.1, 50.0, 3, 0.3, 0.3)], kind)
    cost = spark.createDataFrame([(m, 2.0, 0.5) for m in (1, 2, 3)], "model_id long, slope double, intercept double")
    got = {r.model_id: (r.epochs, r.batch_size) for r in batching.training_budget(frame, cost).collect()}
    assert got[1] == (1, 1) and got[2] == got[3]
    assert batching.one_budget(0.1, 50.0, 2.0, 0.5, 0.0, 0.2) == (1, 1)


def test_registered_user_model(spark):
    spec = register_model("last", lambda p, x: x[:, -1:] * p[0], lambda p, x, y: np.array([0.0]), [2.0], 3)
    assert registered_model("last") is spec and not spec.linear
    frame = window_frame(spark, [(0, 0, 0, [1, 2, 3], [0]), (1, 0, 1, [4, 5, 6], [0])])
    params = spark.createDataFrame([(0, [2.0]), (1, [10.0])], "model_id long, params array<double>")
    assert {r.model_id: r.pred for r in score(frame, params, spec).collect()} == {0: [6.0], 1: [60.0]}
    with pytest.raises(ValueError):
        ModelSpec("half", 3, predict=lambda p, x: x)
