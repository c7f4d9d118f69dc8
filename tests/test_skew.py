"""The plans for hot groups give what the plain ones give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from onlinecast.operators import analytics, batching, memory, promotion, routing, scoring
from onlinecast.operators import windows as win
from onlinecast.plans import joins, ordering
from onlinecast.plans.folds import fold_states
from tests.frames import near, readings, same

SMALL = 20


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows"))
    readings(spark).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def modelled(rows):
    return rows.withColumns(
        {"model_id": (F.col("stream_id") % 2).cast("long"), "k": F.col("event_id"), "t_end": F.col("ts")}
    )


def test_runs_bound_the_group_size(rows):
    cut, cuts = ordering.runs(rows, ["stream_id"], ["ts", "event_id"], SMALL)
    assert cuts == [ordering.RUN]
    assert cut.groupBy("stream_id", *cuts).count().agg(F.max("count")).first()[0] <= 3 * SMALL
    assert cut.count() == rows.count()


@pytest.fixture(scope="module")
def one_hot(spark, tmp_path_factory):
    """A group of 101 rows among many single ones, and one whose key is null."""
    path = str(tmp_path_factory.mktemp("one-hot"))
    i = F.col("id")
    key = F.when(i < 101, F.lit(-1)).when((i >= 200) & (i < 350), F.lit(None)).otherwise(i)
    rows = spark.range(20_000).select(key.cast("int").alias("stream_id"), (i * 7919 % 20_011).alias("ts"), i.alias("event_id"))
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_only_hot_groups_are_cut(one_hot):
    order = ["ts", "event_id"]
    heat = ordering.by_heat(one_hot, ["stream_id"], 100)
    assert heat.rows == 251 and heat.hot.count() == 251 and heat.cool.count() == 20_000 - 251
    cut, _ = ordering.runs(one_hot, ["stream_id"], order, 100)
    assert cut.where(F.col(ordering.RUN) >= 0).select(ordering.RUN).distinct().count() <= 6
    assert cut.where(F.col(ordering.RUN) < 0).count() == heat.cool.count()
    # single rows are numbered by a plain window over the table itself, which is not written again
    plan = ordering.with_position(one_hot, ["stream_id"], order, "pos", 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "one-hot" in "".join(one_hot.inputFiles())
    for frame, plain in (
        (ordering.with_position(one_hot, ["stream_id"], order, "pos", g) for g in (100, None)),
        (ordering.running(one_hot, ["stream_id"], order, "event_id", "sum", "s", False, g) for g in (100, None)),
        (ordering.top_rows(one_hot, ["stream_id"], [F.desc("ts"), "event_id"], 2, g) for g in (100, None)),
        (
            ordering.over_frame(one_hot, ["stream_id"], order, 2, 1, {"n": lambda w: F.sum("event_id").over(w.rowsBetween(-2, 1))}, None, g)
            for g in (100, None)
        ),
    ):
        assert frame.count() == plain.count()
        assert frame.exceptAll(plain.select(*frame.columns)).isEmpty()


def test_tasks_follow_rows_not_the_limit(spark, tmp_path):
    """Runs are as short as the limit asks for, but a low limit does not ask for a partition each."""
    spark.range(30_000).selectExpr("id % 3 AS stream_id", "id DIV 4 AS ts", "-id AS event_id").write.parquet(str(tmp_path / "rows"))
    table, order = spark.read.parquet(str(tmp_path / "rows")), ["ts", "event_id"]
    cut = ordering._cut(ordering.by_heat(table, ["stream_id"], 10), ["stream_id"], order, 10)
    assert len(cut.inputFiles()) <= 2
    sizes = cut.groupBy("stream_id", ordering.RUN).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("b"))
    assert sizes.agg(F.max("n")).first()[0] == 10
    by_run = sorted(sizes.collect(), key=lambda r: (r.stream_id, r[ordering.RUN]))
    assert all(p.b < q.a for p, q in zip(by_run, by_run[1:]) if p.stream_id == q.stream_id)
    same(ordering.with_position(table, ["stream_id"], order, "pos", 10), ordering.with_position(table, ["stream_id"], order, "pos", None))


@pytest.mark.parametrize("group_rows", [3, SMALL, 150])
def test_positions(rows, group_rows):
    args = (rows, ["stream_id"], ["ts", "event_id"], "pos")
    same(ordering.with_position(*args, group_rows), ordering.with_position(*args, None))


@pytest.fixture(scope="module")
def bursts(spark, tmp_path_factory):
    """One stream: a few sparse rows, then bursts within bursts; ids fall while times rise, or are wide and random."""
    path = str(tmp_path_factory.mktemp("bursts"))
    i = F.col("id")
    at = F.when(i < 4, i * 10**12).when(i < 200, F.lit(5 * 10**12) + i).otherwise(F.lit(5 * 10**12 + 200) + F.floor(i / 150))
    rows = spark.range(600).select(
        F.lit(1).alias("stream_id"),
        at.cast("long").alias("ts"),
        (1000 - i).alias("falling"),
        F.xxhash64(i).alias("wide"),
        (i % 3 == 0).alias("late"),
        F.concat(F.lit("e"), (i % 7).cast("string")).alias("kind"),
        F.when(i % 5 > 0, i).alias("id"),
    )
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("group_rows", [10, 20, 50])
@pytest.mark.parametrize(
    "order", [["ts", "falling"], ["late", "ts", "falling"], ["kind", "wide"], ["wide"], ["late", "wide"], ["id", "wide"]]
)
def test_positions_in_any_order(bursts, order, group_rows):
    args = (bursts, ["stream_id"], order, "pos")
    same(ordering.with_position(*args, group_rows), ordering.with_position(*args, None))


def test_running_in_any_order(bursts):
    args = (bursts, ["stream_id"], ["late", "ts", "falling"], "id", "last", "run")
    same(ordering.running(*args, True, 20), ordering.running(*args, True, None))


def test_groups_that_grow_from_little_are_seen(spark, tmp_path):
    path = str(tmp_path / "little")
    spark.range(1).write.parquet(path)
    grown = spark.read.parquet(path).select(F.lit(1).alias("k"), F.explode(F.sequence(F.lit(1), F.lit(5000))).alias("v"))
    assert ordering.hot_groups(grown, ["k"], 1000)[1]
    side = grown.select(F.col("v").alias("k"), F.lit(1).alias("w"))
    plan = joins.attach(grown, side, ["k"], limit=10_000)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_only_hot_keys_are_dealt(rows, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    side = rows.groupBy("stream_id").agg(F.max("value").alias("most"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        same(joins.attach(rows, side.where("stream_id < 3"), ["stream_id"], how, limit=64), rows.join(side.where("stream_id < 3"), ["stream_id"], how))


@pytest.mark.parametrize("kind", ["last", "min", "sum"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(rows, kind, inclusive):
    sparse = rows.withColumn("v", F.when(F.col("event_id") % 3 == 0, F.col("event_id")))
    args = (sparse, ["stream_id"], ["ts", "event_id"], "v", kind, "run", inclusive)
    same(ordering.running(*args, SMALL), ordering.running(*args, None))


@pytest.mark.parametrize("before,after", [(0, 4), (3, 0), (2, 2), (40, 0)])
def test_frames(rows, before, after):
    columns = {"span": lambda w: F.collect_list("value").over(w.rowsBetween(-before, after))}
    args = (rows, ["stream_id"], ["ts", "event_id"], before, after, columns)
    same(ordering.over_frame(*args, "pos", SMALL), ordering.over_frame(*args, "pos", None))
    same(ordering.over_frame(*args, None, SMALL), ordering.over_frame(*args, None, None))


def test_top_rows(rows):
    order = [F.desc("ts"), F.desc("event_id")]
    same(ordering.top_rows(rows, ["stream_id"], order, 5, SMALL), ordering.top_rows(rows, ["stream_id"], order, 5, None))


def test_fold(rows):
    def step(state, value):
        return np.where(state + value % 3 > 7, 0, state + value % 3)

    args = (rows, ["stream_id"], ["ts", "event_id"], "event_id", step, 8, "state")
    same(fold_states(*args, SMALL), fold_states(*args, None))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(rows, how):
    side = rows.where("stream_id < 3").groupBy("stream_id").agg(F.max("value").alias("most"))
    same(joins.attach(rows, side, ["stream_id"], how, limit=0), rows.join(side, ["stream_id"], how))


@pytest.mark.parametrize("size,shift", [(1, 1), (5, 2), (30, 7), (3, 9)])
def test_windows(rows, size, shift):
    same(win.lookback_windows(rows, size, shift, SMALL), win.lookback_windows(rows, size, shift, None))
    same(win.training_windows(rows, size, shift, 2, 3, True, SMALL), win.training_windows(rows, size, shift, 2, 3, True, None))


def test_batches(modelled):
    same(batching.fixed_batches(modelled, 7, SMALL), batching.fixed_batches(modelled, 7, None))
    same(batching.adaptive_batches(modelled, 3, 5000, SMALL), batching.adaptive_batches(modelled, 3, 5000, None))


@pytest.mark.parametrize("scope", ["stream", "model"])
def test_errors(modelled, scope):
    scored = batching.adaptive_batches(
        modelled.select("*", F.array("value").alias("pred"), F.col("value").alias("true")), 3, 900, None
    )
    plain = scoring.one_step_rmse(scored, scope, None)
    near(scoring.one_step_rmse(scored, scope, SMALL), plain, ["model_id", "batch_id", "stream_id"], "loss")
    near(
        scoring.rolling_loss(plain, 3, scope, SMALL),
        scoring.rolling_loss(plain, 3, scope, None),
        ["model_id", "batch_id", "stream_id"],
        "average_loss",
    )


def test_asof(modelled):
    batches = modelled.groupBy("model_id", F.col("event_id").alias("batch_id")).agg(F.max("ts").alias("ts"))
    registry = modelled.where("event_id % 5 = 0").select(
        "model_id", F.col("event_id").alias("version"), F.col("ts").alias("update_time")
    )
    same(routing.asof_model(batches, registry, SMALL), routing.asof_model(batches, registry, None))


@pytest.mark.parametrize("batch_size", [None, 40])
def test_promotion(modelled, batch_size):
    losses = modelled.select(
        "model_id", F.col("event_id").alias("batch_id"), (1 + F.col("event_id") % 60).alias("rows"), F.col("value").alias("loss")
    )
    gates = [promotion.promotion_gate(losses, 288, 10000.0, batch_size, n) for n in (SMALL, None)]
    near(*gates, ["model_id", "batch_id"], "mean_loss")
    near(*gates, ["model_id", "batch_id"], "publish")


def test_memory(modelled):
    batches = batching.fixed_batches(
        modelled.withColumns({"x": F.array("value"), "y": F.array("value")}), 5, None
    )
    for capacity in (3, 8, 33):
        plain = memory.ring_memory_reset(batches, capacity, None)
        if plain.isEmpty():
            continue
        same(memory.ring_memory_reset(batches, capacity, 2), plain)
    same(memory.ring_memory(None, batches, 4, SMALL), memory.ring_memory(None, batches, 4, None))


def test_numbers(modelled):
    documents = modelled.withColumns({"batch_id": F.col("event_id"), "seq": F.col("event_id"), "pos": F.lit(0)})
    same(analytics.number_results(documents, SMALL), analytics.number_results(documents, None))
    same(analytics.latest_points(documents, 6, SMALL), analytics.latest_points(documents, 6, None))
