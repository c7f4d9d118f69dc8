"""Predictions, their errors, and result documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onlinecast.functions.vectors import linear_output
from onlinecast.operators.models import ModelSpec
from onlinecast.operators.parsing import observed_value
from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, over_frame

DOCUMENT = ["model_id", "batch_id", "stream_id"]


def with_params(windows: DataFrame, params: DataFrame | list[float]) -> DataFrame:
    """Windows with the ``params`` of their model (and version, if windows carry one)."""
    if not isinstance(params, DataFrame):
        return windows.withColumn("params", F.array(*[F.lit(float(p)) for p in params]))
    on = ["model_id"] + (["version"] if "version" in windows.columns and "version" in params.columns else [])
    return attach(windows, params.select(*on, "params"), on)


def linear_pred(spec: ModelSpec) -> Column:
    return F.array(*[linear_output("x", F.col("params"), spec.look_back, o) for o in range(spec.outputs)])


def score(windows: DataFrame, params: DataFrame | list[float], spec: ModelSpec) -> DataFrame:
    """Add ``pred`` (one value per output) and ``true`` (the newest value of the window)."""
    rows = with_params(windows, params).withColumn("true", observed_value())
    if spec.linear:
        return rows.withColumn("pred", linear_pred(spec)).drop("params")
    schema = T.StructType([*rows.drop("params").schema.fields, T.StructField("pred", T.ArrayType(T.DoubleType()))])
    model = [c for c in ("model_id", "version") if c in rows.columns]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(model) if model else [(None, batch)]:
                pred = spec.predict(np.asarray(part["params"].iloc[0], float), np.stack(part["x"].to_numpy()).astype(float))
                yield part.drop(columns="params").assign(pred=list(np.asarray(pred, float)))

    return rows.mapInPandas(predict, schema)


def one_step_errors(scored: DataFrame, scope: str = "stream", group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Add ``sq_error`` of the previous prediction against the value now observed.

    The previous prediction is the stream's own (``scope="stream"``) or the last one made by the model for any
    stream (``scope="model"``); null for the first.
    """
    keys, order = {
        "stream": (["model_id", "stream_id"], ["batch_id", "pos"]),
        "model": (["model_id"], ["batch_id", "stream_id", "pos"]),
    }[scope]
    lagged = over_frame(
        scored,
        keys,
        order,
        before=1,
        after=0,
        columns={"__previous": lambda w: F.lag(F.element_at("pred", 1)).over(w)},
        group_rows=group_rows,
    )
    miss = F.col("__previous") - F.col("true")
    return lagged.withColumn("sq_error", miss * miss).drop("__previous")


def one_step_rmse(scored: DataFrame, scope: str = "stream", group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Root mean squared one-step error of each (batch, stream); null without a pair."""
    errors = one_step_errors(scored, scope, group_rows)
    return errors.groupBy(*DOCUMENT).agg(F.sqrt(F.avg("sq_error")).alias("loss"))


def rolling_loss(losses: DataFrame, n: int = 3, scope: str = "stream", group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Add ``average_loss``: mean of the last ``n`` known losses; null where the loss is."""
    keys, order = {
        "stream": (["model_id", "stream_id"], ["batch_id"]),
        "model": (["model_id"], ["batch_id", "stream_id"]),
    }[scope]
    # Rows without a loss form groups of their own, so the frames of the others skip them.
    return over_frame(
        losses.withColumn("__unknown", F.col("loss").isNull()),
        [*keys, "__unknown"],
        order,
        before=n - 1,
        after=0,
        columns={"average_loss": lambda w: F.avg("loss").over(w.rowsBetween(-(n - 1), 0))},
        group_rows=group_rows,
    ).drop("__unknown")


def result_documents(scored: DataFrame, true: str = "true") -> DataFrame:
    """One document per (batch, stream): predictions and true values in order, and the loss if known.

    ``true`` names the observed value, or the target array of training windows. With ``sq_error`` present
    the loss is its root mean; with ``loss`` present (one value per batch) that is kept. A column ``part``
    divides a (batch, stream) that is too long for one document.
    """
    whole = isinstance(scored.schema[true].dataType, T.ArrayType)
    pred = F.col("pred") if whole else F.slice("pred", 1, 1)
    actual = F.col(true) if whole else F.array(true)
    item = F.struct("pos", pred.alias("pred"), actual.alias("true"))
    values = [F.sort_array(F.collect_list(item)).alias("__items"), F.max("t_end").alias("ts")]
    if "sq_error" in scored.columns:
        values.append(F.sqrt(F.avg("sq_error")).alias("loss"))
    elif "loss" in scored.columns:
        values.append(F.max("loss").alias("loss"))
    parts = [c for c in ("part",) if c in scored.columns]
    grouped = scored.groupBy(*DOCUMENT, *parts).agg(*values)
    return grouped.withColumns(
        {"pred": F.flatten("__items.pred"), "true": F.flatten("__items.true")}
    ).drop("__items")


def loss(kind: str, pred: str = "pred", true: str = "y") -> Column:
    """Aggregate loss over rows with array predictions and targets: ``mse`` or ``mae``."""
    if kind == "mse":
        per_value = F.zip_with(pred, true, lambda p, y: (p - y) * (p - y))
    elif kind == "mae":
        per_value = F.zip_with(pred, true, lambda p, y: F.abs(p - y))
    else:
        raise ValueError(f"unknown loss {kind!r}")
    total = F.aggregate(per_value, F.lit(0.0), lambda a, v: a + v)
    return F.sum(total) / F.sum(F.size(pred))
