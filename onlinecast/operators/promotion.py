"""When a trained model is good enough to be published."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.plans.ordering import GROUP_ROWS, over_frame, running, with_position
from onlinecast.plans.tables import written

# Fixed values of the gate.
QUEUE_ROWS = 288
FIRST_BEST = 10000.0


def promotion_gate(
    losses: DataFrame,
    rows: int = QUEUE_ROWS,
    base: float = FIRST_BEST,
    batch_size: int | None = None,
    group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """Mark the batches ``(model_id, batch_id, rows, loss)`` after which the model is published.

    Batches queue up until they hold ``rows`` rows; then each batch looks at the mean loss of the queue and
    drops its oldest one. A mean below every earlier one (and ``base``) publishes; a queue with an unknown loss has no
    mean. With a constant ``batch_size`` the length of the queue is known; else it follows from running sums.
    """
    key, order = ["model_id"], ["batch_id"]
    if batch_size:
        length = math.ceil(rows / batch_size)
        queued = over_frame(
            losses,
            key,
            order,
            before=length - 1,
            after=0,
            columns={
                "mean_loss": lambda w: F.avg("loss").over(w.rowsBetween(-(length - 1), 0)),
                "__queued": lambda w: F.count("loss").over(w.rowsBetween(-(length - 1), 0)),
            },
            group_rows=group_rows,
        )
        queued = queued.withColumn("mean_loss", F.when(F.col("__queued") == length, F.col("mean_loss"))).drop("__queued")
    else:
        queued = _queue_means(losses, key, order, rows, group_rows)
    best = running(queued, key, order, "mean_loss", "min", "__best", inclusive=False, group_rows=group_rows)
    publish = F.col("mean_loss") < F.least(F.lit(base), F.col("__best"))
    return best.withColumn("publish", F.coalesce(publish, F.lit(False))).drop("__best")


def _queue_means(losses: DataFrame, key: list[str], order: list[str], rows: int, group_rows: int | None) -> DataFrame:
    """Mean loss of the queue behind each batch at which it holds ``rows`` rows.

    Let R(i) be the rows of the first i batches. The queue behind batch i (from 0) holds enough as long as it starts at D(i) or before,
    the last place with R(D) <= R(i + 1) - ``rows``; then it loses its oldest batch. Since D never falls, the queue
    starts at min(start + 1, D + 1) next, so before batch i it starts at i + min(0, least D(j) - j of the batches j before
    i): a running minimum. Means are differences of running sums at the two places.
    """

    def total(df: DataFrame, column: str, name: str) -> DataFrame:
        return running(df, key, ["__i"], column, "sum", name, group_rows=group_rows)

    placed = with_position(losses, key, order, "__i", group_rows)
    placed = placed.withColumns({"__held": F.col("rows").cast("long"), "__none": F.col("loss").isNull().cast("long")})
    for column, name in (("__held", "__rows"), ("loss", "__sum"), ("__none", "__nulls")):
        placed = total(placed, column, name)
    placed = written(placed.drop("__held", "__none"), "queue")
    ends = placed.select(*key, (F.col("__i") + 1).alias("__place"), "__rows", F.coalesce("__sum", F.lit(0.0)).alias("__sum"), "__nulls")
    nothing = {"__place": F.lit(0).cast("long"), "__rows": F.lit(0).cast("long"), "__sum": F.lit(0.0), "__nulls": F.lit(0).cast("long")}
    places = ends.unionByName(placed.select(*key).distinct().withColumns(nothing))
    marks = places.select(*key, F.col("__rows").alias("__value"), F.lit(0).alias("__asks"), "__place", F.lit(None).cast("long").alias("__i"))
    asks = placed.select(
        *key, (F.col("__rows") - rows).alias("__value"), F.lit(1).alias("__asks"), F.lit(None).cast("long").alias("__place"), "__i"
    )
    found = running(
        marks.unionByName(asks), key, ["__value", "__asks", "__place", "__i"], "__place", "last", "__last", group_rows=group_rows
    )
    found = found.where("__asks = 1").select(*key, "__i", F.coalesce("__last", F.lit(-1)).alias("__last"))
    found = found.withColumn("__slack", F.col("__last") - F.col("__i"))
    found = running(found, key, ["__i"], "__slack", "min", "__least", inclusive=False, group_rows=group_rows)
    start = F.col("__i") + F.least(F.lit(0).cast("long"), F.coalesce("__least", F.lit(0).cast("long")))
    found = found.withColumn("__place", start).where("__place <= __last").select(*key, "__i", "__place")
    before = places.select(*key, "__place", F.col("__sum").alias("__sum0"), F.col("__nulls").alias("__nulls0"))
    queued = placed.join(found.join(before, [*key, "__place"]), [*key, "__i"], "left")
    mean = (F.coalesce("__sum", F.lit(0.0)) - F.col("__sum0")) / (F.col("__i") + 1 - F.col("__place"))
    queued = queued.withColumn("mean_loss", F.when(F.col("__nulls") == F.col("__nulls0"), mean))
    return queued.drop("__i", "__place", "__rows", "__sum", "__sum0", "__nulls", "__nulls0")
