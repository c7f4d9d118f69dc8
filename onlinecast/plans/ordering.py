"""Ordered work per group (positions, frames, running values, top rows) without a hot task.

A plain ``Window.partitionBy(keys)`` sends each group to one task. That is the right plan while
groups are small, and every function here uses it for those. When a count finds groups above
``group_rows`` rows, their rows, and no others, are dealt to range partitions by ``(keys, order)``, sorted there and
written once with the number of their run, of which a partition has one for every ``group_rows`` rows. A group is then a
row of consecutive runs, the window works per run, and what earlier runs contribute (a count, a last value) is
joined in. Partitions follow the rows and runs the limit, so a low limit asks for no more tasks. This holds for every
type and any spread of the order columns. ``group_rows=None`` says that groups are known to be small; nothing is counted then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onlinecast.plans.joins import BROADCAST_BYTES, attach, salt
from onlinecast.plans.tables import settled, size_bound, written

GROUP_ROWS = 1_000_000
PARTITION_ROWS = 1 << 18
SETTLE_BYTES = 8 << 20
RUN = "__run"
PARTITION_BITS = 33  # of ``monotonically_increasing_id``: below the number of the partition, that of the row in it


def hot_groups(
    df: DataFrame, keys: list[str], group_rows: int | None = GROUP_ROWS
) -> tuple[DataFrame, bool]:
    """``df``, ready to be evaluated again, and whether a group has more than ``group_rows`` rows."""
    if group_rows is None:
        return df, False
    df = settled(df, SETTLE_BYTES)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return df, not sizes.where(F.col("n") > group_rows).isEmpty()


class Heat(NamedTuple):
    """Rows of groups within the limit, those of groups beyond it (None without any) and the number of the latter."""

    cool: DataFrame
    hot: DataFrame | None
    rows: int


def by_heat(df: DataFrame, keys: list[str], group_rows: int | None = GROUP_ROWS) -> Heat:
    """Part the rows by the size of their group. There are at most 1 / ``group_rows`` as many hot keys as rows."""
    df, hot = hot_groups(df, keys, group_rows)
    if not hot:
        return Heat(df, None, 0)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > group_rows)
    named = written(sizes.withColumnsRenamed({k: f"__hot_{k}" for k in keys}), "hot")
    side = F.broadcast(named) if size_bound(named) <= BROADCAST_BYTES else named
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    rows = named.agg(F.sum("__n")).first()[0]
    return Heat(df.join(side, same, "left_anti"), df.join(side, same, "left_semi"), rows)


def _cut(heat: Heat, keys: list[str], order: list[str], group_rows: int) -> DataFrame:
    """Hot rows with the number of their run: what ``group_rows`` consecutive rows of a range partition hold of a group.

    Runs rise with the order columns whatever their types. Rows with equal order columns may be in neighbouring runs.
    """
    parts = 2 * -(-heat.rows // max(group_rows, PARTITION_ROWS))
    df = heat.hot
    plain = [c for c, f in zip(df.columns, df.schema.fields, strict=True) if not isinstance(f.dataType, T.MapType)]
    ranged = df.repartitionByRange(parts, *keys, *order, F.xxhash64(*plain)).sortWithinPartitions(*keys, *order)
    at = F.monotonically_increasing_id()
    row = at.bitwiseAND((1 << PARTITION_BITS) - 1)
    run = F.shiftleft(F.shiftright(at, PARTITION_BITS), PARTITION_BITS) + F.floor(row / group_rows)
    return written(ranged.withColumn(RUN, run), "runs")


def runs(
    df: DataFrame, keys: list[str], order: list[str], group_rows: int | None = GROUP_ROWS
) -> tuple[DataFrame, list[str]]:
    """Cut the groups above ``group_rows`` into consecutive runs; returns the frame and the run columns.

    Groups within the limit are one run. There are no run columns when no group is too large.
    """
    heat = by_heat(df, keys, group_rows)
    if heat.hot is None:
        return heat.cool, []
    whole = heat.cool.withColumn(RUN, F.lit(-1).cast("long"))
    return whole.unionByName(_cut(heat, keys, order, group_rows)), [RUN]


def with_position(
    df: DataFrame, keys: list[str], order: list[str], name: str = "pos", group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """Add the dense 0-based position of each row in its group."""

    def local(*by: str) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long") - 1

    heat = by_heat(df, keys, group_rows)
    cool = heat.cool.withColumn(name, local(*keys))
    if heat.hot is None:
        return cool
    cut = _cut(heat, keys, order, group_rows)
    sizes = cut.groupBy(*keys, RUN).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    cut = _with_run(cut, starts, keys).withColumn(name, F.col("__start") + local(*keys, RUN)).drop("__start", RUN)
    return cool.unionByName(cut)


def _with_run(cut: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of runs with what is known of their run; a key may be null, so they meet by a hash and are then compared."""
    known = {k: f"__of_{k}" for k in [*keys, RUN]}
    facts = facts.withColumnsRenamed(known).withColumn("__which", F.xxhash64(*known.values()))
    joined = attach(cut.withColumn("__which", F.xxhash64(*known)), facts, ["__which"])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(other)) for k, other in known.items()])
    return joined.where(same).drop("__which", *known.values())


def over_frame(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: int,
    after: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    position: str | None = None,
    group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    Each callable gets the ordered window and applies its own frame. The rows of hot groups
    are cut by position into blocks, and each block also gets the neighbours its frames reach.
    """
    heat = by_heat(df, keys, group_rows)
    w = Window.partitionBy(*keys).orderBy(*order)
    cool = heat.cool
    if position:
        cool = cool.withColumn(position, F.row_number().over(w).cast("long") - 1)
    cool = cool.withColumns({name: build(w) for name, build in columns.items()})
    if heat.hot is None:
        return cool
    at = position or "__pos"
    block = max(group_rows, before + after + 1)
    hot = with_position(heat.hot, keys, order, at, group_rows)
    first = F.floor(F.greatest(F.col(at) - after, F.lit(0)) / block)
    last = F.floor((F.col(at) + before) / block)
    hot = hot.withColumn("__block", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*keys, "__block").orderBy(at)
    hot = hot.withColumns({name: build(w) for name, build in columns.items()})
    hot = hot.where(F.floor(F.col(at) / block) == F.col("__block")).drop("__block")
    return cool.unionByName(hot if position else hot.drop(at))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    column: str,
    kind: str,
    name: str,
    inclusive: bool = True,
    group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Add the running ``last`` (non-null), ``min`` or ``sum`` of ``column`` in each group."""
    value = F.col(column)
    folds = {
        "last": lambda c, w: F.last(c, ignorenulls=True).over(w),
        "min": lambda c, w: F.min(c).over(w),
        "sum": lambda c, w: F.sum(c).over(w),
    }
    fold = folds[kind]

    def inner(*by: str) -> WindowSpec:
        return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)

    heat = by_heat(df, keys, group_rows)
    cool = heat.cool.withColumn(name, fold(value, inner(*keys)))
    if heat.hot is None:
        return cool
    cut = _cut(heat, keys, order, group_rows)
    totals = {
        "last": F.max_by(value, F.when(value.isNotNull(), F.struct(*order))),
        "min": F.min(value),
        "sum": F.sum(value),
    }
    per_run = cut.groupBy(*keys, RUN).agg(totals[kind].alias("__run_value"))
    earlier = Window.partitionBy(*keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_run.withColumn("__carry", fold(F.col("__run_value"), earlier)).drop("__run_value")
    own, carried = fold(value, inner(*keys, RUN)), F.col("__carry")
    merged = {
        "last": F.coalesce(own, carried),
        "min": F.least(own, carried),
        "sum": F.coalesce(own + carried, own, carried),
    }
    cut = _with_run(cut, carry, keys).withColumn(name, merged[kind]).drop("__carry", RUN)
    return cool.unionByName(cut)


def top_rows(
    df: DataFrame, keys: list[str], order: list[Column], n: int, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """First ``n`` rows of each group in ``order``; a hot group is first reduced per salt."""

    def keep(frame: DataFrame, by: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return frame.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")

    heat = by_heat(df, keys, group_rows)
    if heat.hot is None:
        return keep(heat.cool, keys)
    salted = keep(heat.hot.withColumn("__salt", salt(heat.hot)), [*keys, "__salt"]).drop("__salt")
    return keep(heat.cool, keys).unionByName(keep(salted, keys))
