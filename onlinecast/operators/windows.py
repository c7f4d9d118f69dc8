"""Count-based windows over each stream.

With readings ``v0 .. v(n-1)`` per stream, window ``k`` starts at reading ``k * shift``.
``t_end`` is the time of the reading whose arrival completes the window. Readings must be non-null;
``decode_readings`` sees to that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onlinecast.plans.joins import attach
from onlinecast.plans.ordering import GROUP_ROWS, top_rows, with_position
from onlinecast.plans.tables import written

STREAM = ["stream_id"]
ORDER = ["ts", "event_id"]
BLOCK = 1024
LEAST_REACH = 64
TAIL_SCHEMA = "stream_id int, pos long, ts timestamp, event_id long, value double"


@dataclass(frozen=True)
class WindowShape:
    """Readings per window. A training window also has a target of ``forward_size`` readings,
    ``forward_step`` after its last input, and waits for one more reading if ``wait_extra``."""

    look_back: int
    shift: int = 1
    forward_step: int = 1
    forward_size: int = 0
    wait_extra: bool = True

    @property
    def training(self) -> bool:
        return self.forward_size > 0

    @property
    def target(self) -> tuple[int, int]:
        """First and last offset of the target."""
        first = self.look_back + self.forward_step - 1
        return first, first + self.forward_size - 1

    @property
    def needed(self) -> int:
        """Readings from the window's start until it is complete."""
        return self.target[1] + (2 if self.wait_extra else 1) if self.training else self.look_back


def _placed(readings: DataFrame, group_rows: int | None) -> DataFrame:
    return with_position(readings.select("stream_id", *ORDER, "value"), STREAM, ORDER, "pos", group_rows)


def _blocks(placed: DataFrame, reach: int) -> DataFrame:
    """Consecutive readings of each stream as arrays, a block per row.

    A block also gets the ``reach - 1`` readings after it, so every window that starts in a block lies
    within its row, and no row grows with the length of its stream.
    """
    size = max(BLOCK, 4 * reach)
    first = F.floor(F.greatest(F.col("pos") - (reach - 1), F.lit(0)) / size)
    parts = ["pos", "value", "ts"] + (["fresh"] if "fresh" in placed.columns else [])
    spread = placed.withColumn("block", F.explode(F.sequence(first, F.floor(F.col("pos") / size))))
    rows = spread.groupBy("stream_id", "block").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("rows"))
    return rows.select(
        "stream_id",
        F.col("rows")[0]["pos"].alias("first"),
        ((F.col("block") + 1) * size - 1).alias("last"),
        F.col("rows.value").alias("value"),
        F.col("rows.ts").alias("ts"),
        *[F.col(f"rows.{c}").alias(c) for c in parts[3:]],
    )


def _starts(shift: Column, needed: Column) -> Column:
    """The ``k`` of the windows that start in a block and are complete."""
    earliest = F.ceil(F.col("first") / shift)
    latest = F.floor(F.least(F.col("last"), F.col("first") + F.size("value") - needed) / shift)
    return F.when(latest >= earliest, F.sequence(earliest, latest))


def _part(column: str, shift: Column, offset: Column, length: Column) -> Column:
    """``length`` values of a block from ``offset`` after the start of window ``k``."""
    at = F.col("k") * shift - F.col("first") + offset + 1
    return F.slice(column, at.cast("int"), length)


def _item(column: str, shift: Column, offset: Column) -> Column:
    return F.element_at(column, (F.col("k") * shift - F.col("first") + offset + 1).cast("int"))


def _windows(placed: DataFrame, shape: WindowShape) -> DataFrame:
    shift, needed = F.lit(shape.shift), F.lit(shape.needed)
    started = _blocks(placed, shape.needed).withColumn("k", F.explode(_starts(shift, needed)))
    if "fresh" in placed.columns:
        started = started.where(_item("fresh", shift, needed - 1))
    columns = [
        "stream_id",
        "k",
        _item("ts", shift, needed - 1).alias("t_end"),
        _part("value", shift, F.lit(0), F.lit(shape.look_back)).alias("x"),
    ]
    if shape.training:
        columns.append(_part("value", shift, F.lit(shape.target[0]), F.lit(shape.forward_size)).alias("y"))
    return started.select(*columns)


def shaped_windows(readings: DataFrame, shape: WindowShape, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """All windows of a shape."""
    return _windows(_placed(readings, group_rows), shape)


def lookback_windows(
    readings: DataFrame, look_back: int, shift: int = 1, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """``look_back`` consecutive readings, emitted once all of them have arrived."""
    return shaped_windows(readings, WindowShape(look_back, shift), group_rows)


def training_windows(
    readings: DataFrame,
    look_back: int,
    shift: int = 1,
    forward_step: int = 1,
    forward_size: int = 1,
    wait_extra: bool = True,
    group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Input ``x`` with the target ``y`` that lies ``forward_step`` readings ahead.

    ``wait_extra`` holds a window until one reading beyond its target has arrived.
    """
    shape = WindowShape(look_back, shift, forward_step, forward_size, wait_extra)
    return shaped_windows(readings, shape, group_rows)


def continued_windows(
    fresh: DataFrame, tail: DataFrame, shape: WindowShape, group_rows: int | None = GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Windows that newly arrived readings complete, and the tail the next arrivals need.

    ``tail`` holds the last readings of each stream with their positions, as this function left it.
    """
    slim = with_position(fresh.select("stream_id", *ORDER, "value"), STREAM, ORDER, "__at", group_rows)
    tail = attach(tail, fresh.select("stream_id").distinct(), STREAM, "left_semi")
    reached = tail.groupBy("stream_id").agg(F.max("pos").alias("__reached"))
    placed = attach(slim, reached, STREAM, "left").withColumn(
        "pos", F.coalesce(F.col("__reached") + 1, F.lit(0)) + F.col("__at")
    )
    rows = tail.withColumn("fresh", F.lit(False)).unionByName(
        placed.drop("__at", "__reached").withColumn("fresh", F.lit(True))
    )
    kept = top_rows(rows, STREAM, [F.desc("pos")], max(1, shape.needed - 1), group_rows)
    return _windows(rows, shape), kept.drop("fresh")


def multi_stream_windows(
    readings: DataFrame, members: DataFrame, look_back: int, shift: int = 1, group_rows: int | None = GROUP_ROWS
) -> DataFrame:
    """Windows with the same ``k`` of all streams of a group, side by side.

    ``members(group_id, stream_id)`` names the streams of each group. A window waits for one reading
    more than it holds, on every stream of its group. ``streams`` lists the blocks of ``x`` in order.
    """
    shift_by, needed = F.lit(shift), F.lit(look_back + 1)
    started = _blocks(_placed(readings, group_rows), look_back + 1).withColumn(
        "k", F.explode(_starts(shift_by, needed))
    )
    ready = started.select(
        "stream_id",
        "k",
        _item("ts", shift_by, F.lit(look_back)).alias("t_end"),
        _part("value", shift_by, F.lit(0), F.lit(look_back)).alias("x"),
    )
    sizes = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("expected"))
    blocks = attach(ready, members.join(sizes, "group_id"), STREAM)
    grouped = blocks.groupBy("group_id", "expected", "k").agg(
        F.sort_array(F.collect_list(F.struct("stream_id", "x"))).alias("blocks"), F.max("t_end").alias("t_end")
    )
    return grouped.where(F.size("blocks") == F.col("expected")).select(
        "group_id",
        "k",
        "t_end",
        F.col("blocks.stream_id").alias("streams"),
        F.flatten("blocks.x").alias("x"),
    )


def model_windows(readings: DataFrame, subscriptions: DataFrame, group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Windows of every (model, stream), each model with its own shape.

    ``subscriptions(model_id, stream_id, look_back, shift, forward_step, forward_size)``; the two forward
    columns are null for inference. Blocks must cover the longest reach, so models are grouped by the
    power of two that covers theirs; the blocks of a class are made once for all its models. Without
    subscriptions there are no windows.
    """
    training = F.col("forward_step").isNotNull()
    target = F.col("look_back") + F.col("forward_step") - 1
    needed = F.when(training, target + F.col("forward_size") + 1).otherwise(F.col("look_back"))
    shaped = subscriptions.withColumn("needed", needed).withColumn(
        "reach", F.greatest(F.lit(LEAST_REACH), F.pow(2, F.ceil(F.log2("needed"))).cast("int"))
    )
    placed = _placed(attach(readings, shaped.select("stream_id").distinct(), STREAM, "left_semi"), group_rows)
    classes = sorted(row[0] for row in shaped.select("reach").distinct().collect()) or [LEAST_REACH]  # powers of two
    placed = written(placed, "placed") if len(classes) > 1 else placed
    result = None
    for reach in classes:
        mine = shaped.where(F.col("reach") == reach)
        wanted = attach(placed, mine.select("stream_id").distinct(), STREAM, "left_semi")
        started = attach(_blocks(wanted, reach), mine, STREAM).withColumn(
            "k", F.explode(_starts(F.col("shift"), F.col("needed")))
        )
        windows = started.select(
            "model_id",
            "stream_id",
            F.when(training, "train").otherwise("infer").alias("mode"),
            "k",
            _item("ts", F.col("shift"), F.col("needed") - 1).alias("t_end"),
            _part("value", F.col("shift"), F.lit(0), F.col("look_back")).alias("x"),
            F.when(training, _part("value", F.col("shift"), target, F.col("forward_size"))).alias("y"),
        )
        result = windows if result is None else result.unionByName(windows)
    return result
