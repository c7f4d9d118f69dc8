"""Micro-batches and the training budget of each tick."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, over_frame, with_position

ARRIVAL = ["t_end", "stream_id", "k"]
PER_TICK = 1 << 31

# Fixed values of the budget rule.
ERROR_WEIGHT = 60000.0
ERROR_MEMORY = 5
FIRST_ERROR = 0.3


def numbered_batch(tick: Column, part: Column) -> Column:
    """``tick * PER_TICK + part``; an error if a tick has more batches than that leaves room for."""
    full = F.raise_error(F.lit(f"more than {PER_TICK} batches of a model in one tick"))
    return F.when(part < PER_TICK, tick * PER_TICK + part).otherwise(full.cast("long"))


def fixed_batches(
    windows: DataFrame, size: int, group_rows: int | None = GROUP_ROWS, keep_tail: bool = False
) -> DataFrame:
    """Batches of ``size`` windows per model in arrival order; an incomplete last one only with ``keep_tail``."""
    placed = with_position(windows, ["model_id"], ARRIVAL, "__at", group_rows)
    placed = placed.withColumn("batch_id", F.floor(F.col("__at") / size)).withColumn(
        "pos", (F.col("__at") % size).cast("int")
    )
    if keep_tail:
        return placed.drop("__at")
    held = windows.groupBy("model_id").agg(F.count(F.lit(1)).alias("__held"))
    placed = attach(placed, held, ["model_id"])
    return placed.where((F.col("batch_id") + 1) * size <= F.col("__held")).drop("__at", "__held")


def adaptive_batches(
    windows: DataFrame, size: int, tick_seconds: int, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """All windows that wait at the end of a tick, in batches of at most ``size``.

    ``batch_id`` is the tick number times 2^31 plus the batch's number within the tick.
    """
    ticked = windows.withColumn("tick", F.floor(F.unix_seconds("t_end") / tick_seconds))
    placed = with_position(ticked, ["model_id", "tick"], ARRIVAL, "__at", group_rows)
    return (
        placed.withColumn("batch_id", numbered_batch(F.col("tick"), F.floor(F.col("__at") / size)))
        .withColumn("pos", (F.col("__at") % size).cast("int"))
        .drop("__at")
    )


def arrival_rate(readings: DataFrame, tick_seconds: int, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Arrivals per second of each model's ticks, measured since its last tick that had arrivals."""
    tick = F.floor(F.unix_seconds("ts") / tick_seconds)
    counts = readings.groupBy("model_id", tick.alias("tick")).agg(F.count(F.lit(1)).alias("arrivals"))
    lagged = over_frame(
        counts,
        ["model_id"],
        ["tick"],
        before=1,
        after=0,
        columns={"previous": lambda w: F.lag("tick").over(w)},
        group_rows=group_rows,
    )
    elapsed = (F.coalesce(F.col("tick") - F.col("previous"), F.lit(1)) * tick_seconds).cast("double")
    return lagged.withColumn("elapsed", elapsed).withColumn("rate", F.col("arrivals") / elapsed).drop("previous")


def fit_cost_model(profile: DataFrame) -> DataFrame:
    """Seconds per (epochs x rows) of each model, by least squares on its timings."""
    return profile.groupBy("model_id").agg(
        F.regr_slope("seconds", "work").alias("slope"), F.regr_intercept("seconds", "work").alias("intercept")
    )


def recent_error(
    losses: DataFrame, size: int = ERROR_MEMORY, init: float = FIRST_ERROR, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """Mean of the ``size`` errors before each one; missing ones count as ``init``."""

    def mean(w):
        past = w.rowsBetween(-size, -1)
        known = F.coalesce(F.sum("loss").over(past), F.lit(0.0))
        return (known + init * (size - F.count("loss").over(past))) / size

    return over_frame(
        losses, ["model_id"], ["batch_id"], size, 0, {"recent_error": mean}, group_rows=group_rows
    )


class Columns:
    """Functions of the budget rule on columns."""

    sqrt, cbrt, cos, acos, divide = F.sqrt, F.cbrt, F.cos, F.acos, F.try_divide

    @staticmethod
    def where(condition: Column, yes: Column | float, no: Column | float) -> Column:
        return F.when(condition, yes).otherwise(no)

    @staticmethod
    def greatest(a: Column, b: Column | float) -> Column:
        return F.greatest(a, b if isinstance(b, Column) else F.lit(b))

    @staticmethod
    def least(a: Column, b: Column | float) -> Column:
        return F.least(a, b if isinstance(b, Column) else F.lit(b))


class Numbers:
    """The same on numpy numbers."""

    sqrt, cbrt, cos, acos, where = np.sqrt, np.cbrt, np.cos, np.arccos, np.where
    greatest, least, divide = np.fmax, np.fmin, staticmethod(lambda a, b: np.where(b == 0, -np.inf, np.divide(a, b)))


def best_rows(e, rate, slope, intercept, ratio, m=Columns):
    """The positive root d of d^3/rate + (slope*e - intercept) d^2 - M*ratio/e = 0, which gives ``e`` epochs their least cost.

    There is exactly one. With b = rate*(slope*e - intercept) <= 0 the cubic has no other real root, and its closed form adds
    positive terms only. Else the reciprocal of d solves a cubic without a square term, in closed form or, where
    that has three real roots, by the cosine of a third of an angle; neither subtracts. Without an error (ratio 0) d is
    -b, or 0.
    """
    b = rate * (slope * e - intercept)
    c = rate * ERROR_WEIGHT * ratio / e
    half = c / 2 - b * b * b / 27
    third = b / 3
    larger = m.cbrt(half + m.sqrt(m.greatest(half * half - third * third * third * third * third * third, 0.0)))
    direct = larger + third * third / larger - third
    p, q = b / (3 * c), 1 / (2 * c)
    disc = q * q - p * p * p
    outer = m.cbrt(q + m.sqrt(m.greatest(disc, 0.0)))
    angle = m.acos(m.least(q / (p * m.sqrt(p)), 1.0))
    reciprocal = m.where(disc >= 0, outer + p / outer, 2 * m.sqrt(p) * m.cos(angle / 3))
    return m.where(c <= 0, m.greatest(-b, 0.0), m.where(b <= 0, direct, 1 / reciprocal))


def cost_of(e, d, rate, slope, intercept, ratio, m=Columns):
    """Cost of training ``e`` epochs on ``d`` rows."""
    left = m.where(d > 0, ERROR_WEIGHT * ratio / (e * d), 0.0)
    return d * d / (2 * rate) + slope * d * e - intercept * d + left


def epoch_range(rate, elapsed, slope, intercept, ratio, m=Columns):
    """Seconds since the last training, the most epochs, and the epochs at which the cost turns from falling to rising."""
    elapsed = m.greatest(elapsed, m.divide(intercept, 1 - slope * rate))
    bound = (elapsed - intercept) / (slope * rate * elapsed)
    turn = m.where(intercept > 0, m.sqrt(ERROR_WEIGHT * ratio / slope) / (intercept * rate), bound)
    return elapsed, bound, turn


def one_budget(
    rate: float, elapsed: float, slope: float, intercept: float, error: float, recent_error: float, method: str = "grid"
) -> tuple[int, int]:
    """Epochs and rows of one training: ``training_budget`` of one tick, in numbers."""
    rate, elapsed, slope, intercept = (np.float64(v) for v in (rate, elapsed, slope, intercept))
    ratio = np.float64(error / recent_error if recent_error else 1.0)
    with np.errstate(all="ignore"):
        _, bound, turn = epoch_range(rate, elapsed, slope, intercept, ratio, Numbers)
        if method == "real":
            choices = [max(min(turn, bound), 1.0)]
        elif method == "grid":
            turn = min(max(turn, 1.0), bound)
            choices = [1.0] if bound < 1 else [np.floor(turn), min(np.ceil(turn), np.floor(bound)), bound]
        else:
            raise ValueError(f"unknown method {method!r}")
        sized = [(e, best_rows(e, rate, slope, intercept, ratio, Numbers)) for e in choices]
        _, epochs, rows = min((float(cost_of(e, d, rate, slope, intercept, ratio, Numbers)), e, d) for e, d in sized)
    return max(int(np.floor(epochs)), 1), max(int(np.floor(rows)), 1)


def training_budget(ticks: DataFrame, cost: DataFrame, method: str = "grid") -> DataFrame:
    """Epochs and rows to train on in each tick.

    ``ticks(model_id, tick, rate, elapsed, backlog, error, recent_error)``, ``cost`` from ``fit_cost_model``. Where the
    recent error is 0, the error counts as equal to it.
    The cost falls until sqrt(M*ratio/slope)/(intercept*rate) epochs and rises after it. ``grid`` takes the
    best whole epoch in [1, bound] or the bound itself, so only those next to that point need to be compared.
    ``real`` takes the point itself, or the end of [1, bound] next to it.
    """
    rows = attach(ticks, cost, ["model_id"]).withColumnRenamed("slope", "__b").withColumnRenamed("intercept", "__b1")
    rate, slope, intercept = F.col("rate"), F.col("__b"), F.col("__b1")
    rows = rows.withColumn("__ratio", F.coalesce(F.try_divide("error", "recent_error"), F.lit(1.0)))
    ratio = F.col("__ratio")
    elapsed, bound, turn = epoch_range(rate, F.col("elapsed"), slope, intercept, ratio)
    rows = rows.withColumns({"elapsed": elapsed, "__bound": bound, "__turn": turn})
    bound, turn = F.col("__bound"), F.col("__turn")
    if method == "grid":
        turn = F.least(F.greatest(turn, F.lit(1.0)), bound)
        choices = F.when(bound < 1, F.array(F.lit(1.0))).otherwise(
            F.array(F.floor(turn).cast("double"), F.least(F.ceil(turn).cast("double"), F.floor(bound).cast("double")), bound)
        )
        sized = F.transform(
            choices, lambda e: F.struct(e.alias("epochs"), best_rows(e, rate, slope, intercept, ratio).alias("rows"))
        )
        weighed = F.transform(
            sized,
            lambda c: F.struct(
                cost_of(c["epochs"], c["rows"], rate, slope, intercept, ratio).alias("cost"),
                c["epochs"].alias("epochs"),
                c["rows"].alias("rows"),
            ),
        )
        rows = rows.withColumn("__best", F.array_min(weighed))
    elif method == "real":
        epochs = F.greatest(F.least(turn, bound), F.lit(1.0))
        best = F.struct(epochs.alias("epochs"), best_rows(epochs, rate, slope, intercept, ratio).alias("rows"))
        rows = rows.withColumn("__best", best)
    else:
        raise ValueError(f"unknown method {method!r}")
    size = F.greatest(F.floor("__best.rows"), F.lit(1))
    return (
        rows.withColumn("epochs", F.greatest(F.floor("__best.epochs"), F.lit(1)))
        .withColumn("batch_size", size)
        .withColumn("wait_seconds", F.greatest((size - F.col("backlog")) / rate, F.lit(0.0)))
        .drop("__b", "__b1", "__ratio", "__bound", "__turn", "__best")
    )
