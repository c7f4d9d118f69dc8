"""Count-based windows of unbounded readings.

The streaming frames keep a state per stream, and a stream's readings of one micro-batch meet in one
task; the source's rate limit bounds them. ``windows_job`` has no such task: it divides long streams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from onlinecast.operators.windows import ORDER, TAIL_SCHEMA, WindowShape, continued_windows
from onlinecast.streaming.state import JobPaths, run_batches

STATE = T.StructType(
    [
        T.StructField("seen", T.LongType()),
        T.StructField("next_k", T.LongType()),
        T.StructField("waiting", T.ArrayType(T.DoubleType())),
    ]
)
OUTPUT = [
    T.StructField("stream_id", T.IntegerType()),
    T.StructField("k", T.LongType()),
    T.StructField("t_end", T.TimestampType()),
    T.StructField("x", T.ArrayType(T.DoubleType())),
    T.StructField("y", T.ArrayType(T.DoubleType())),
]


def _windows_stream(readings: DataFrame, shape: WindowShape) -> DataFrame:
    """Per stream the state is the readings that a later window still starts at or covers.

    Readings of a micro-batch are taken in (ts, event_id) order; earlier micro-batches come first.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, next_k, waiting = state.get if state.exists else (0, 0, [])
        parts = list(batches)
        ts, ids, fresh = (np.concatenate([p[c].to_numpy() for p in parts]) for c in (*ORDER, "value"))
        order = np.lexsort((ids, ts))
        first, before = seen - len(waiting), seen
        values = np.concatenate([np.asarray(waiting, float), fresh[order]])
        seen += len(order)
        ks = np.arange(next_k, max(next_k, (seen - shape.needed) // shape.shift + 1 if seen >= shape.needed else 0))
        next_k += len(ks)
        keep = max(0, min(next_k * shape.shift - first, len(values)))
        state.update((int(seen), int(next_k), values[keep:].tolist()))
        if not len(ks):
            return
        starts = ks * shape.shift - first
        out = pd.DataFrame({"stream_id": key[0], "k": ks})
        out["t_end"] = ts[order][ks * shape.shift + shape.needed - 1 - before]
        out["x"] = list(np.lib.stride_tricks.sliding_window_view(values, shape.look_back)[starts])
        if shape.training:
            targets = np.lib.stride_tricks.sliding_window_view(values, shape.forward_size)
            out["y"] = list(targets[starts + shape.target[0]])
        yield out

    slim = readings.select("stream_id", *ORDER, "value")
    output = T.StructType(OUTPUT if shape.training else OUTPUT[:-1])
    return slim.groupBy("stream_id").applyInPandasWithState(
        advance, output, STATE, "append", GroupStateTimeout.NoTimeout
    )


def lookback_windows_stream(readings: DataFrame, look_back: int, shift: int = 1) -> DataFrame:
    """``lookback_windows`` of a streaming frame."""
    return _windows_stream(readings, WindowShape(look_back, shift))


def training_windows_stream(
    readings: DataFrame,
    look_back: int,
    shift: int = 1,
    forward_step: int = 1,
    forward_size: int = 1,
    wait_extra: bool = True,
) -> DataFrame:
    """``training_windows`` of a streaming frame."""
    return _windows_stream(readings, WindowShape(look_back, shift, forward_step, forward_size, wait_extra))


def windows_job(
    readings: DataFrame, shape: WindowShape, paths: JobPaths, trigger: dict | None = None
) -> StreamingQuery:
    """Write the windows that arriving readings complete to the results path, a folder per micro-batch."""
    tails = paths.table(readings.sparkSession, "tails", TAIL_SCHEMA, ["stream_id"])

    def step(batch: DataFrame, batch_id: int) -> None:
        windows, tail = continued_windows(batch, tails.read(batch_id), shape)
        tails.write(tail, batch_id)
        windows.write.mode("overwrite").parquet(f"{paths.results}/run={batch_id}")

    return run_batches(readings, step, paths, trigger)
