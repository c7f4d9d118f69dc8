"""Sequential integer state per group, scanned in parallel where a group is large."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, runs


def fold_states(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    column: str,
    step: Callable[[np.ndarray, int], np.ndarray],
    states: int,
    name: str,
    group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Add the state before each row, starting each group at 0: ``state = step(state, column)``.

    States are ``0 .. states-1`` and ``step`` takes an array of them, so a run of a large group can be
    summarised as the map from its first state to its last. The maps are composed over the runs of a
    group, then every run is replayed from the state it really starts in.
    """
    needed = [c for c in df.columns if c != name]
    df, cuts = runs(df.select(*needed), keys, order, group_rows)
    long = T.LongType()

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        state = np.array([pdf["__first"].iloc[0] if "__first" in pdf else 0])
        seen = np.empty(len(pdf), "int64")
        for i, value in enumerate(pdf[column].to_numpy()):
            seen[i] = state[0]
            state = step(state, value)
        return pdf.assign(**{name: seen})

    def out(frame: DataFrame) -> T.StructType:
        return T.StructType([*frame.schema.fields, T.StructField(name, long)])

    if not cuts:
        return df.groupBy(*keys).applyInPandas(replay, out(df))
    group = [*keys, *cuts]

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        state = np.arange(states)
        for value in pdf[column].to_numpy():
            state = step(state, value)
        return pdf[group].head(1).assign(__map=[state])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(cuts)
        first, state = [], 0
        for mapped in pdf["__map"]:
            first.append(state)
            state = int(mapped[state])
        return pdf[group].assign(__first=first)

    fields = [df.schema[c] for c in group]
    slim = df.select(*dict.fromkeys([*group, *order, column]))
    maps = slim.groupBy(*group).applyInPandas(
        summarise, T.StructType([*fields, T.StructField("__map", T.ArrayType(long))])
    )
    firsts = maps.groupBy(*keys).applyInPandas(chain, T.StructType([*fields, T.StructField("__first", long)]))
    df = attach(df, firsts, group)
    return df.groupBy(*group).applyInPandas(replay, out(df)).drop("__first", *cuts)
