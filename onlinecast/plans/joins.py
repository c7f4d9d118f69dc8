"""Joins of row tables with per-key tables, safe when one key holds much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onlinecast.plans.tables import input_bytes, settled, size_bound, written

BROADCAST_BYTES = 32 << 20
SALTS = 32
HOT_ROWS = 1_000_000


def salt(df: DataFrame, by: list[str] | None = None, salts: int = SALTS):
    """Salt that is a function of the row, so a recomputed task repeats it."""
    return F.pmod(F.xxhash64(*(by or df.columns)), F.lit(salts)).cast("int")


def _dealt(rows: DataFrame, side: DataFrame, on: list[str], limit: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with a salt on which they can join: hot keys have as many salts as they have ``HOT_ROWS``."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT_ROWS)
    hot = written(counts.select(*on, F.ceil(F.col("__n") / HOT_ROWS).cast("int").alias("__salts")), "hot")
    if hot.isEmpty() or size_bound(hot) > limit:
        return rows, side, on
    several = F.coalesce(F.col("__salts"), F.lit(1))
    rows = rows.join(F.broadcast(hot), on, "left")
    plain = [c for c, f in zip(rows.columns, rows.schema.fields, strict=True) if not isinstance(f.dataType, T.MapType)]
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*plain), several).cast("int"))
    side = side.join(F.broadcast(hot), on, "left")
    side = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), several - 1)))
    return rows.drop("__salts"), side.drop("__salts"), [*on, "__salt"]


def attach(
    rows: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` (large, skewed) with ``side`` (a few rows per key).

    ``side`` is measured, and broadcast if it is within ``limit`` bytes. Beyond that both sides shuffle; the
    rows of a key with more than ``HOT_ROWS`` are dealt to several tasks, and only its row of ``side`` is copied.
    The keys of a stream cannot be counted; its rows all get one of ``salts`` salts.
    """
    if input_bytes(side) > limit // 4:
        side = written(side, "side")
    if size_bound(side) <= limit:
        return rows.join(F.broadcast(side), on, how)
    if not rows.isStreaming:
        rows, side, keys = _dealt(settled(rows, limit), side, on, limit)
        return rows.join(side, keys, how).drop("__salt")
    rows = rows.withColumn("__salt", salt(rows, [c for c in rows.columns if c not in on], salts))
    side = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(side, [*on, "__salt"], how).drop("__salt")
