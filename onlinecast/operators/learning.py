"""Gradients, fitting, projection and parameter updates, for all models of a frame at once.

Parameters are ``(model_id, params array<double>)``; gradients are long: ``(model_id, .., p, g)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onlinecast.operators.models import ModelSpec
from onlinecast.operators.scoring import linear_pred, loss, score, with_params
from onlinecast.plans.joins import attach
from onlinecast.plans.tables import written

GRAM_STREAMS = 1024
MOST_STEPS = 200
PRECISION = 1e-10
GRAM_BLOCK = 2048
FLUSH_GROUPS = 1000
FLUSH_NUMBERS = 1 << 22
ROUNDING = 1e-12
ROUNDED = 8 * np.finfo(float).eps
FLAT = (0.9, 0.1)
LOOSE_STEPS = 50
MOST_CUTS = 5
HALVES = 2.0 ** -np.arange(41)

# Fixed values of the projection.
MARGIN = 0.5
RIDGE = 1e-3


def gradient(
    windows: DataFrame, params: DataFrame | list[float], spec: ModelSpec, group: list[str] | None = None
) -> DataFrame:
    """Gradient of the mean loss over the windows of each group (default: each model)."""
    group = group or ["model_id"]
    rows = with_params(windows, params)
    if not spec.linear:
        return _partial_gradients(rows, spec, group)
    rows = rows.withColumn("pred", linear_pred(spec))
    sums = []
    for o in range(spec.outputs):
        miss = F.element_at("pred", o + 1) - F.element_at("y", o + 1)
        miss = 2 * miss if spec.loss == "mse" else F.signum(miss)
        sums += [F.sum(miss * F.element_at("x", i + 1)) for i in range(spec.look_back)] + [F.sum(miss)]
    totals = rows.groupBy(*group).agg(F.array(*sums).alias("__sums"), F.count(F.lit(1)).alias("__n"))
    return totals.select(*group, "__n", F.posexplode("__sums").alias("p", "__g")).select(
        *group, "p", (F.col("__g") / (F.col("__n") * spec.outputs)).alias("g")
    )


def _partial_gradients(rows: DataFrame, spec: ModelSpec, group: list[str]) -> DataFrame:
    """Sum gradients per Arrow batch inside the tasks, then over all tasks."""
    keys = list(dict.fromkeys([*group, *(["model_id"] if "model_id" in rows.columns else [])]))
    fields = [rows.schema[c] for c in group]
    schema = T.StructType(
        [*fields, T.StructField("g", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())]
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, list] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(*k, list(g), n) for k, (g, n) in sums.items()], columns=schema.fieldNames())
            sums.clear()
            return out

        for batch in batches:
            for key, part in batch.groupby(keys):
                x, y = (np.stack(part[c].to_numpy()).astype(float) for c in ("x", "y"))
                g = len(part) * spec.gradient(np.asarray(part["params"].iloc[0], float), x, y)
                total, n = sums.get(key[: len(group)], (0.0, 0))
                sums[key[: len(group)]] = (total + g, n + len(part))
            if len(sums) > FLUSH_GROUPS:
                yield flush()
        if sums:
            yield flush()

    parts = rows.select(*keys, "x", "y", "params").mapInPandas(partial, schema)
    long = parts.select(*group, "n", F.posexplode("g").alias("p", "part"))
    return long.groupBy(*group, "p").agg((F.sum("part") / F.sum("n")).alias("g"))


def memory_gradients(memory: DataFrame, params: DataFrame | list[float], spec: ModelSpec) -> DataFrame:
    """One gradient per stream that has memory."""
    return gradient(memory, params, spec, ["model_id", "stream_id"])


def conflicts(current: DataFrame, memories: DataFrame) -> DataFrame:
    """Per stream, the dot product of its memory gradient with the model's current one, and if it is negative."""
    other = current.withColumnRenamed("g", "__g")
    return (
        attach(memories, other, ["model_id", "p"])
        .groupBy("model_id", "stream_id")
        .agg(F.sum(F.col("g") * F.col("__g")).alias("dot"))
        .withColumn("conflict", F.col("dot") < 0)
    )


def project_gradient(
    current: DataFrame,
    memories: DataFrame,
    margin: float = MARGIN,
    ridge: float = RIDGE,
    method: str = "exact",
) -> DataFrame:
    """Gradient changed so that it does not work against the memory gradients.

    ``exact`` solves the dual quadratic program (multipliers of at least ``margin``): with the products of all pairs
    of streams where no model has more than ``GRAM_STREAMS``, else by steps that only ever hold as many numbers as
    a model has parameters, squared. Both give the same gradient. ``average`` removes what points against the
    mean memory gradient. Models without a conflict keep their gradient.
    """
    if method == "average":
        return _project_average(current, memories)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    facts = written(conflicts(current, memories), "dots")
    shape = facts.groupBy("model_id").agg(
        F.max("conflict").alias("conflict"), F.count(F.lit(1)).alias("streams")
    )
    widest = shape.agg(F.max("streams")).first()[0] or 0
    turned = shape.where("conflict").select("model_id")
    hit = attach(memories, turned, ["model_id"], "left_semi")
    if widest > GRAM_STREAMS:
        shift = _shift_by_parameters(current, hit, margin, ridge)
        return _shifted(current, shift)
    weights = _multipliers(_gram(hit), facts, margin, ridge)
    shift = (
        attach(hit, weights, ["model_id", "stream_id"])
        .groupBy("model_id", "p")
        .agg(F.sum(F.col("v") * F.col("g")).alias("__shift"))
    )
    return _shifted(current, shift)


def _shifted(current: DataFrame, shift: DataFrame) -> DataFrame:
    moved = F.col("g") + F.coalesce("__shift", F.lit(0.0))
    return current.join(shift, ["model_id", "p"], "left").withColumn("g", moved).drop("__shift")


def _in_order(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The numbers of each key as one array in the order of their parameters."""
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("p", "g"))).alias("__all"))
    return listed.select(*keys, F.col("__all.g").alias(name), F.col("__all.p").alias("places"))


def _shift_by_parameters(current: DataFrame, memories: DataFrame, margin: float, ridge: float) -> DataFrame:
    """Shift w = sum of v * g over the streams, for the multipliers v >= margin that the dual program asks for.

    At the solution v is the larger of ``margin`` and ``-g . z / ridge`` for the turned gradient z = current + w. Once it is known
    which streams are above the margin, z solves a linear system with as many unknowns as parameters, whose sums
    tasks make and the cluster adds up. Each step solves it for the streams above the margin at the last point; the last one finds
    the same streams again, and how many there are does not matter to the number of steps. A step is the Newton step of a strictly
    convex function, so it goes only as far as that falls: its slopes at several shares of a step are sums, too.
    """
    model = memories.schema["model_id"]
    arrays = T.ArrayType(T.DoubleType())
    now = _in_order(current, ["model_id"], "now")
    vectors = _in_order(memories, ["model_id", "stream_id"], "vector").drop("places")
    vectors = written(vectors, "vectors")
    state = now.join(vectors.select("model_id").distinct(), "model_id", "left_semi")
    state = state.withColumns({"z": F.col("now"), "start": F.col("now"), "step": F.transform("now", lambda _: F.lit(0.0))})
    shares = F.array(*[F.lit(float(v)) for v in (1.0, *HALVES)])
    state = state.withColumns({"shares": shares, "slope": F.lit(0.0), "cuts": F.lit(0), "done": F.lit(False)})
    state = written(state, "state")
    parts = T.StructType([model, T.StructField("i", T.IntegerType()), T.StructField("row", arrays), T.StructField("held", T.DoubleType())])

    def linear_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for name, part in batch.groupby("model_id"):
                g = np.stack(part["vector"].to_numpy())
                along, first, rise = (g @ np.asarray(part[c].iloc[0]) for c in ("z", "start", "step"))
                free = along < -margin * ridge
                pulls = np.maximum(margin, -(first + np.outer(part["shares"].iloc[0], rise)) / ridge)
                form, held, slopes = sums.get(name, (0.0, 0.0, 0.0))
                sums[name] = form + g[free].T @ g[free], held + g[~free].sum(axis=0), slopes - pulls @ rise
        for name, (form, held, slopes) in sums.items():
            places = np.arange(len(held) + 1, dtype="int32")
            yield pd.DataFrame({"model_id": name, "i": places, "row": [*form, slopes], "held": [*held, 0.0]})

    def advance(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        now, z, start, step, shares = (np.asarray(pdf[c].iloc[0]) for c in ("now", "z", "start", "step", "shares"))
        slope, cuts, rows = float(pdf["slope"].iloc[0]), int(pdf["cuts"].iloc[0]), pdf["row"].to_numpy()
        matrix, held = ridge * np.eye(len(z)) + np.stack(rows[:-1]), pdf["held"].to_numpy()[:-1]
        newton = np.linalg.solve(matrix, ridge * (now + margin * held)) - z
        scale, values = np.abs(z + newton).max(), np.linalg.eigvalsh(matrix)
        blurred = (values[-1] * scale + ridge * (np.abs(now).max() + margin * np.abs(held).max())) / max(values[0], ridge)
        done = bool(pdf["done"].iloc[0] or np.abs(newton).max() <= max(PRECISION * scale, ROUNDED * blurred))
        slopes = (start + np.outer(shares, step) - now) @ step + rows[-1]
        if done or not abs(slopes[0]) > flat * abs(slope) or cuts == MOST_CUTS:
            start, step, shares, cuts = z, newton, np.array([1.0, *HALVES]), 0
            slope = -float(newton @ matrix @ newton) / ridge
        else:
            # the lowest point is between the last share at which the function falls and the next one
            at, of = np.array([0.0, *shares]), np.array([slope, *slopes])
            low = int(np.where(of <= 0, at, -1.0).argmax())
            high = int(np.where((of > 0) & (at > at[low]), at, np.inf).argmin())
            share = 1.0
            if of[high] > 0:
                share = at[low] + (at[high] - at[low]) * of[low] / (of[low] - of[high])
            shares, cuts = np.array([share, *np.linspace(at[low], at[high], len(HALVES))]), cuts + 1
        first = pdf.iloc[:1].drop(columns=["i", "row", "held"])
        z = start + shares[0] * step
        return first.assign(z=[z], start=[start], step=[step], shares=[shares], slope=slope, cuts=cuts, done=done)

    for turn in range(MOST_STEPS):
        flat = FLAT[turn >= LOOSE_STEPS]
        rows = attach(vectors, state.select("model_id", "z", "start", "step", "shares"), ["model_id"])
        forms = rows.drop("stream_id").mapInPandas(linear_forms, parts)
        total = F.aggregate(
            F.slice("rows", F.lit(2), F.size("rows")), F.col("rows")[0], lambda a, b: F.zip_with(a, b, lambda p, q: p + q)
        )
        forms = forms.groupBy("model_id", "i").agg(F.collect_list("row").alias("rows"), F.sum("held").alias("held"))
        forms = forms.select("model_id", "i", total.alias("row"), "held").join(state, "model_id")
        state = written(forms.groupBy("model_id").applyInPandas(advance, state.schema), "state")
        if state.where("not done").isEmpty():
            break
    else:
        raise ValueError(f"the projection did not settle within {MOST_STEPS} steps")
    return state.select("model_id", F.explode(F.arrays_zip("places", "z", "now")).alias("at")).select(
        "model_id", F.col("at.places").alias("p"), (F.col("at.z") - F.col("at.now")).alias("__shift")
    )


def _project_average(current: DataFrame, memories: DataFrame) -> DataFrame:
    mean = memories.groupBy("model_id", "p").agg(F.avg("g").alias("m"))
    pairs = current.join(mean, ["model_id", "p"], "left")
    both = pairs.groupBy("model_id").agg(F.sum(F.col("g") * F.col("m")).alias("gm"), F.sum(F.col("m") * F.col("m")).alias("mm"))
    factor = F.when(F.col("gm") < 0, F.try_divide("gm", "mm")).otherwise(F.lit(0.0))
    changed = attach(pairs, both, ["model_id"])
    return changed.select("model_id", "p", (F.col("g") - F.coalesce(factor * F.col("m"), F.lit(0.0))).alias("g"))


def _gram(memories: DataFrame) -> DataFrame:
    """Dot products of each memory gradient with all of its model, in the order of their streams.

    Each task multiplies the gradients over a block of parameters; the blocks are summed.
    """
    ids = [memories.schema["model_id"], memories.schema["stream_id"]]
    schema = T.StructType([*ids, T.StructField("row", T.ArrayType(T.DoubleType()))])

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index="stream_id", columns="p", values="g")
        values = wide.to_numpy()
        return pd.DataFrame(
            {"model_id": pdf["model_id"].iloc[0], "stream_id": wide.index, "row": list(values @ values.T)}
        )

    blocks = memories.withColumn("__block", F.floor(F.col("p") / GRAM_BLOCK))
    rows = blocks.groupBy("model_id", "__block").applyInPandas(multiply, schema)
    rows = rows.groupBy("model_id", "stream_id").agg(F.collect_list("row").alias("rows"))
    total = F.aggregate(
        F.slice("rows", F.lit(2), F.size("rows")),
        F.col("rows")[0],
        lambda a, b: F.zip_with(a, b, lambda p, q: p + q),
    )
    return rows.select("model_id", "stream_id", total.alias("row"))


def _multipliers(gram: DataFrame, dots: DataFrame, margin: float, ridge: float) -> DataFrame:
    """Multipliers v >= margin that minimise v'Pv/2 + dots'v, with P the Gram matrix plus ``ridge`` on its diagonal."""
    schema = T.StructType([gram.schema["model_id"], gram.schema["stream_id"], T.StructField("v", T.DoubleType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("stream_id")
        matrix = np.stack(pdf["row"].to_numpy()).astype(float)
        matrix = (matrix + matrix.T) / 2 + ridge * np.eye(len(pdf))
        return pdf[["model_id", "stream_id"]].assign(v=bounded_minimum(matrix, pdf["dot"].to_numpy(float), margin))

    rows = gram.join(dots.select("model_id", "stream_id", "dot"), ["model_id", "stream_id"])
    return rows.groupBy("model_id").applyInPandas(solve, schema)


def bounded_minimum(matrix: np.ndarray, linear: np.ndarray, bound: float) -> np.ndarray:
    """Minimum of v'Av/2 + b'v over v >= bound for a positive definite A, by an active set of bounds.

    Components at the bound leave it while that lowers the objective; the free ones solve a linear
    system, cut back where it would cross the bound.
    """
    v = np.full(len(linear), float(bound))
    free = np.zeros(len(linear), bool)
    scale = np.abs(matrix).max() * max(1.0, abs(bound)) + np.abs(linear).max()
    for _ in range(20 * len(linear) + 20):
        slope = matrix @ v + linear
        pull = np.where(free, 0.0, slope)
        worst = int(pull.argmin())
        if pull[worst] >= -1e-12 * scale:
            break
        free[worst] = True
        while free.any():
            held = ~free
            right = -linear[free] - matrix[np.ix_(free, held)] @ v[held]
            target = np.linalg.solve(matrix[np.ix_(free, free)], right)
            low = target < bound
            if not low.any():
                v[free] = target
                break
            now = v[free]
            room = np.full(len(now), np.inf)
            room[low] = (now[low] - bound) / (now[low] - target[low])
            reach = room.min()
            v[free] = now + reach * (target - now)
            stuck = np.flatnonzero(free)[room <= reach]
            v[stuck] = bound
            free[stuck] = False
    else:
        raise ValueError("the bounded minimum was not reached")
    return v


def apply_update(
    params: DataFrame,
    grads: DataFrame,
    lr: float,
    optimizer: str = "sgd",
    momentum: float = 0.9,
    betas: tuple[float, float] = (0.9, 0.999),
    eps: float = 1e-7,
) -> DataFrame:
    """One optimizer step on the parameters of every model that has a gradient.

    ``momentum`` keeps the array ``m``; ``adam`` keeps ``m``, ``v`` and the step count ``t``. Missing state
    columns start at zero.
    """
    flat = grads.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("p", "g"))).alias("__pg"))
    rows = params.join(flat.select("model_id", F.col("__pg.g").alias("__g")), "model_id", "left")
    moved = F.col("__g").isNotNull()
    zeros = F.transform("params", lambda w: F.lit(0.0))

    def state(name: str) -> Column:
        return F.coalesce(F.col(name), zeros) if name in params.columns else zeros

    def step(w: Column, d: Column) -> Column:
        return F.zip_with(w, d, lambda a, b: a - lr * b)

    if optimizer == "sgd":
        rows = rows.withColumn("params", F.when(moved, step(F.col("params"), F.col("__g"))).otherwise(F.col("params")))
    elif optimizer == "momentum":
        m = F.zip_with(state("m"), F.coalesce("__g", zeros), lambda a, g: momentum * a + g)
        rows = rows.withColumn("m", F.when(moved, m).otherwise(state("m")))
        rows = rows.withColumn("params", F.when(moved, step(F.col("params"), F.col("m"))).otherwise(F.col("params")))
    elif optimizer == "adam":
        b1, b2 = betas
        count = F.coalesce(F.col("t"), F.lit(0)) if "t" in params.columns else F.lit(0)
        m = F.zip_with(state("m"), F.coalesce("__g", zeros), lambda a, g: b1 * a + (1 - b1) * g)
        v = F.zip_with(state("v"), F.coalesce("__g", zeros), lambda a, g: b2 * a + (1 - b2) * g * g)
        rows = rows.withColumns(
            {
                "t": F.when(moved, count + 1).otherwise(count),
                "m": F.when(moved, m).otherwise(state("m")),
                "v": F.when(moved, v).otherwise(state("v")),
            }
        )
        grow = F.sqrt(1 - F.pow(F.lit(b2), F.col("t"))) / (1 - F.pow(F.lit(b1), F.col("t")))
        delta = F.zip_with("m", "v", lambda a, b: grow * a / (F.sqrt(b) + eps))
        rows = rows.withColumn("params", F.when(moved, step(F.col("params"), delta)).otherwise(F.col("params")))
    else:
        raise ValueError(f"unknown optimizer {optimizer!r}")
    return rows.drop("__g")


def evaluate(windows: DataFrame, params: DataFrame | list[float], spec: ModelSpec) -> DataFrame:
    """Mean loss of each model on its training windows."""
    return score(windows, params, spec).groupBy("model_id").agg(loss(spec.loss).alias("loss"))


def fit_epochs(
    windows: DataFrame, params: DataFrame, spec: ModelSpec, epochs: int | str, lr: float
) -> DataFrame:
    """Full-batch gradient steps of each model on its windows; returns ``model_id, params, loss``.

    ``epochs`` is a number, or the name of a column of ``params``. ``loss`` is that of the last step, before it
    is taken. The squared loss of a linear model depends on its windows only through their sums of
    products, so one pass over the windows serves all epochs; other models pass over them every epoch.
    """
    if spec.linear and spec.loss == "mse":
        return _fit_linear(windows, params, spec, epochs, lr)
    rows = written(windows.select("model_id", "x", "y"), "fit")
    count = F.lit(epochs) if isinstance(epochs, int) else F.col(epochs)
    state = params.select("model_id", "params", count.alias("__left"), F.lit(None).cast("double").alias("loss"))
    state = written(state, "params")
    for _ in range(state.agg(F.max("__left")).first()[0] or 0):
        active = state.where(F.col("__left") > 0)
        batch = attach(rows, active.select("model_id"), ["model_id"], "left_semi")
        latest = evaluate(batch, active, spec).withColumnRenamed("loss", "__loss")
        moved = apply_update(active, gradient(batch, active, spec), lr).join(latest, "model_id", "left")
        moved = moved.withColumn("loss", F.coalesce("__loss", "loss")).withColumn("__left", F.col("__left") - 1)
        rest = state.where(F.col("__left") <= 0)
        state = written(moved.select(*state.columns).unionByName(rest), "params")
    return state.drop("__left")


def sums_of_products(windows: DataFrame, spec: ModelSpec) -> DataFrame:
    """Per model the number of windows and the sums of the products of all pairs of (x, 1, y), as the upper triangle by rows.

    Every task multiplies whole Arrow batches and adds them up; the numbers of the tasks are then summed by their place, so nothing
    but a row a model and task leaves a task, however wide the windows are.
    """
    wide = spec.look_back + 1 + spec.outputs
    left, right = np.triu_indices(wide)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            # windows are counted by the product of the ones
            out = pa.RecordBatch.from_pydict({"model_id": list(sums), "part": list(sums.values())}, schema)
            sums.clear()
            return out

        for batch in batches:
            models = batch.column("model_id").to_numpy()
            x, y = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(models), -1) for c in ("x", "y"))
            rows = np.hstack([x, np.ones((len(models), 1)), y])
            order = np.argsort(models, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(models[order])) + 1):
                if len(part):
                    some = rows[part]
                    sums[int(models[part[0]])] = sums.get(int(models[part[0]]), 0.0) + (some.T @ some)[left, right]
            if len(sums) * len(left) > FLUSH_NUMBERS:
                yield flush()
        if sums:
            yield flush()

    schema = pa.schema([("model_id", pa.int64()), ("part", pa.list_(pa.float64()))])
    parts = windows.select(F.col("model_id").cast("long"), "x", "y").mapInArrow(add, "model_id long, part array<double>")
    places = parts.select("model_id", F.posexplode("part").alias("p", "v")).groupBy("model_id", "p").agg(F.sum("v").alias("v"))
    listed = places.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("p", "v"))).alias("__all"))
    ones = int(np.flatnonzero((left == spec.look_back) & (right == spec.look_back))[0])
    return listed.select("model_id", F.col("__all.v").alias("products"), F.round(F.col("__all")[ones]["v"]).cast("long").alias("rows"))


def fit_products(
    spec: ModelSpec, params: np.ndarray, products: np.ndarray, rows: int, epochs: int, lr: float
) -> tuple[np.ndarray, float]:
    """Parameters after ``epochs`` full-batch steps on ``rows`` windows, and the loss before the last of them.

    ``products`` are the sums of products of all pairs of (x, 1, y). In the basis of the eigenvectors of the inputs'
    part each weight moves by itself, so any number of epochs is one step. A loss that is rounding counts as 0.
    """
    wide = spec.look_back + 1
    if not np.isfinite(products).all():
        return np.full(len(params), np.nan), float("nan")
    inputs, cross, targets = products[:wide, :wide], products[:wide, wide:], products[wide:, wide:].trace()
    scale = 2 * lr / (rows * spec.outputs)
    values, basis = np.linalg.eigh(inputs)
    values = np.maximum(values, 0.0)
    shrink = 1 - scale * values
    pull = scale * cross.T @ basis
    first = params.reshape(spec.outputs, -1) @ basis
    flat = values * scale < 1e-12

    def after(steps: int) -> np.ndarray:
        power = shrink**steps
        sums = np.where(flat, steps, (1 - power) / np.where(flat, 1.0, 1 - shrink))
        return (first * power + pull * sums) @ basis.T

    last = after(epochs - 1)
    loss = float(np.sum((last @ inputs) * last) - 2 * np.sum(last * cross.T) + targets)
    known = loss > ROUNDING * max(float(targets), float(np.sum((last @ inputs) * last)))
    return after(epochs).ravel(), loss / (rows * spec.outputs) if known or np.isnan(loss) else 0.0


def _fit_linear(windows: DataFrame, params: DataFrame, spec: ModelSpec, epochs: int | str, lr: float) -> DataFrame:
    count = F.lit(epochs) if isinstance(epochs, int) else F.col(epochs)
    rows = params.select("model_id", "params", count.cast("long").alias("epochs"))
    rows = rows.join(sums_of_products(windows, spec), "model_id", "left")
    place = np.triu_indices(spec.look_back + 1 + spec.outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fitted, losses = [], []
            for row in batch.to_pylist():
                weights, loss = row["params"], None
                if row["rows"] and (row["epochs"] or 0) > 0:
                    products = np.zeros((place[0].max() + 1,) * 2)
                    products[place] = products[place[::-1]] = row["products"]
                    weights, loss = fit_products(spec, np.array(weights, float), products, row["rows"], row["epochs"], lr)
                fitted.append(list(weights))
                losses.append(loss)
            yield pa.RecordBatch.from_arrays(
                [batch.column("model_id"), pa.array(fitted, pa.list_(pa.float64())), pa.array(losses, pa.float64())],
                names=["model_id", "params", "loss"],
            )

    return rows.mapInArrow(run, T.StructType([rows.schema["model_id"], *T.StructType.fromDDL("params array<double>, loss double").fields]))
