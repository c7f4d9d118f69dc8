"""Empty, short, malformed and degenerate inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from onlinecast.functions import cosine_to_ones, stream_id
from onlinecast.operators import analytics, batching, parsing, registry, routing, scoring
from onlinecast.operators import windows as win
from onlinecast.sources import (
    append_results,
    decode_readings,
    format_window_record,
    parse_window_record,
    read_readings,
    read_results,
    rejected_readings,
    write_results,
)
from tests.frames import same

START = dt.datetime(2024, 1, 1)


def stream(spark, counts):
    rows = [(s, START + dt.timedelta(seconds=i), i, float(i)) for s, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "stream_id int, ts timestamp, event_id long, value double")


def found(windows):
    return {(r.stream_id, r.k): (list(r.x), list(r.y) if "y" in r else None) for r in windows.collect()}


def test_empty_input(spark):
    nothing = stream(spark, {})
    assert win.lookback_windows(nothing, 3).count() == 0
    assert win.training_windows(nothing, 3).count() == 0


def test_short_streams(spark):
    rows = stream(spark, {1: 2, 2: 3, 3: 4})
    assert set(found(win.lookback_windows(rows, 3))) == {(2, 0), (3, 0), (3, 1)}
    assert win.lookback_windows(rows, 9).count() == 0
    assert found(win.lookback_windows(rows, 1, 3)) == {(1, 0): ([0.0], None), (2, 0): ([0.0], None), (3, 0): ([0.0], None), (3, 1): ([3.0], None)}


def test_shift_beyond_the_window(spark):
    rows = stream(spark, {1: 10})
    assert found(win.lookback_windows(rows, 2, 4)) == {(1, 0): ([0, 1], None), (1, 1): ([4, 5], None), (1, 2): ([8, 9], None)}
    assert set(found(win.lookback_windows(rows, 2, 50))) == {(1, 0)}


def test_training_windows_wait_for_one_more_reading(spark):
    assert found(win.training_windows(stream(spark, {1: 5}), 3, 1, 1, 1)) == {(1, 0): ([0, 1, 2], [3])}
    late = win.training_windows(stream(spark, {1: 5}), 3, 1, 1, 1, wait_extra=False)
    assert found(late) == {(1, 0): ([0, 1, 2], [3]), (1, 1): ([1, 2, 3], [4])}
    gap = win.training_windows(stream(spark, {1: 9}), 2, 2, 3, 2)
    assert found(gap) == {(1, 0): ([0, 1], [4, 5]), (1, 1): ([2, 3], [6, 7])}


def test_windows_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(win, "BLOCK", 2)
    rows = stream(spark, {1: 40})
    got = found(win.lookback_windows(rows, 3, 2))
    assert got == {(1, k): ([2 * k, 2 * k + 1, 2 * k + 2], None) for k in range(19)}


def test_groups_wait_for_their_shortest_stream(spark):
    rows = stream(spark, {1: 6, 2: 4})
    members = spark.createDataFrame([(0, 1), (0, 2)], "group_id long, stream_id int")
    got = {r.k: (r.streams, r.x) for r in win.multi_stream_windows(rows, members, 2).collect()}
    assert got == {0: ([1, 2], [0, 1, 0, 1]), 1: ([1, 2], [1, 2, 1, 2])}


def test_model_windows_equal_windows_of_their_shape(spark):
    rows = stream(spark, {1: 30, 2: 11})
    subs = spark.createDataFrame(
        [(7, 1, "infer", 3, 2, None, None), (8, 2, "train", 2, 1, 2, 1), (8, 9, "train", 2, 1, 2, 1)],
        "model_id long, stream_id int, mode string, look_back int, shift int, forward_step int, forward_size int",
    )
    got = win.model_windows(rows, subs)
    one = win.lookback_windows(rows.where("stream_id = 1"), 3, 2)
    two = win.training_windows(rows.where("stream_id = 2"), 2, 1, 2, 1)
    same(got.where("model_id = 7").select(one.columns), one)
    same(got.where("model_id = 8").select(two.columns), two)


def test_malformed_messages(spark, tmp_path):
    rows = [("sensor.ami1", b"1.5"), ("sensor.ami2", b" -3 "), ("sensor.ami3", b"x"), ("other", b"1"), ("sensor.ami4", None)]
    data = [(t, START, i, bytearray(p) if p else None) for i, (t, p) in enumerate(rows)]
    schema = "topic string, ts timestamp, event_id long, payload binary"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "m"))
    raw = read_readings(spark, "parquet", {"path": str(tmp_path / "m")}, schema=schema)
    assert {(r.stream_id, r.value) for r in decode_readings(raw).collect()} == {(1, 1.5), (2, -3.0)}
    assert {(r.event_id, r.reason) for r in rejected_readings(raw).collect()} == {(2, "payload"), (3, "topic"), (4, "payload")}


def test_stream_ids(spark):
    topics = spark.createDataFrame([("a.ami12",), ("a.amix",), ("b.ami3",), ("aXami4",)], "topic string")
    got = {r.topic: r.id for r in topics.select("topic", stream_id("topic", "a.ami").alias("id")).collect()}
    assert got == {"a.ami12": 12, "a.amix": None, "b.ami3": None, "aXami4": None}


def test_records_round_trip(spark):
    windows = win.training_windows(stream(spark, {4: 9}), 2, 1, 1, 2)
    records = format_window_record(windows)
    assert records.orderBy("k").first().record == "0.0,1.0,2.0,3.0,sensor.ami4,"
    back = parse_window_record(records.select("k", "t_end", "record"), 2)
    same(back.select("stream_id", "k", "t_end", "x", "y"), windows)
    bare = format_window_record(win.lookback_windows(stream(spark, {4: 3}), 2))
    assert [list(r.y) for r in parse_window_record(bare.select("record"), 2).collect()] == [[], []]
    broken = spark.createDataFrame([("1,oops,sensor.ami1,",)], "record string")
    assert list(parse_window_record(broken, 2).first().x) == [1.0, None]


def test_cosine_of_a_zero_vector(spark):
    rows = spark.createDataFrame([([0.0, 0.0],), ([2.0, 2.0],), ([1.0, -1.0],)], "x array<double>")
    assert [round(r[0], 9) for r in rows.select(cosine_to_ones("x")).collect()] == [0, 1, 0]


def test_a_loss_of_zero_counts(spark):
    rows = [(0, 1, b, loss) for b, loss in enumerate([None, 0.0, 3.0, None, 6.0, 9.0])]
    losses = spark.createDataFrame(rows, "model_id long, stream_id int, batch_id long, loss double")
    got = [r.average_loss for r in scoring.rolling_loss(losses).orderBy("batch_id").collect()]
    assert got == [None, 0.0, 1.5, None, 3.0, 6.0]


def test_incomplete_batches(spark):
    windows = win.lookback_windows(stream(spark, {1: 12}), 2).withColumn("model_id", F.lit(0).cast("long"))
    full = batching.fixed_batches(windows, 4).groupBy("batch_id").count()
    assert sorted(map(tuple, full.collect())) == [(0, 4), (1, 4)]
    assert batching.fixed_batches(windows, 20).count() == 0
    partial = batching.adaptive_batches(windows, 3, 5).groupBy("tick", "batch_id").count().orderBy("batch_id")
    first = int(START.replace(tzinfo=dt.timezone.utc).timestamp()) // 5
    assert [(r.tick - first, r["count"]) for r in partial.collect()] == [(0, 3), (0, 1), (1, 3), (1, 2), (2, 2)]


def test_equal_parameters_are_no_change(spark):
    rows = [(0, 1, [1.0]), (0, 2, [1.0]), (0, 3, [2.0])]
    changes = registry.weight_change(spark.createDataFrame(rows, "model_id long, version long, params array<double>"))
    assert [r.changed for r in changes.orderBy("version").collect()] == [False, False, True]


def test_registry_lookups(spark):
    entries = [(0, 1, START, 100.0, [1.0]), (0, 2, START, 0.5, [2.0])]
    known = spark.createDataFrame(entries, "model_id long, version long, update_time timestamp, loss double, params array<double>")
    asked = spark.createDataFrame([(0, 0.4), (0, 0.5), (0, 7.0), (1, 1.0)], "model_id long, loss double")
    got = {(r.model_id, r.loss): (r.status, r.version) for r in routing.loss_gated_lookup(asked, known).collect()}
    assert got == {(0, 0.4): ("refused", None), (0, 0.5): ("found", 2), (0, 7.0): ("found", 2), (1, 1.0): ("unknown", None)}


def test_states_without_models(spark):
    models = spark.createDataFrame([("deploy",)], "state string")
    assert {r.state: r.models for r in registry.count_by_state(models).collect()} == {"deploy": 1, "pause": 0}
    assert {r.state: r.models for r in registry.count_by_state(models.limit(0)).collect()} == {"deploy": 0, "pause": 0}


def test_catalog_ignores_other_topics(spark):
    rows = [("sensor.ami1", START), ("noise", START), ("sensor.ami1", START)]
    catalog = parsing.stream_catalog(spark.createDataFrame(rows, "topic string, ts timestamp"), "sensor.").collect()
    assert [(r.namespace, r.name, r.readings) for r in catalog] == [("sensor", "ami1", 2)]


def test_results_table(spark, tmp_path):
    path = str(tmp_path / "r")
    one = spark.createDataFrame([(1, 0, 0, 5, [1.0], [2.0])], "model_id long, seq long, batch_id long, stream_id int, pred array<double>, true array<double>")
    write_results(one, path, restart=True)
    append_results(one.withColumn("seq", F.lit(1).cast("long")), path, 0)
    append_results(one.withColumn("seq", F.lit(1).cast("long")), path, 0)
    assert sorted(r.seq for r in read_results(spark, path, 1).collect()) == [0, 1]
    assert read_results(spark, path, 2).count() == 0
    plan = read_results(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    write_results(one, path, restart=True)
    assert read_results(spark, path).count() == 1


def test_marker_points(spark):
    schema = "model_id long, seq long, stream_id int, pred array<double>, true array<double>, loss double, average_loss double, ts timestamp, updated_at timestamp"
    results = spark.createDataFrame([(0, 0, 1, [1.0, 2.0], [3.0, 4.0], 0.5, 0.5, START, None), (0, 1, None, None, None, None, None, None, START)], schema)
    members = spark.createDataFrame([(0, 1), (0, 2)], "model_id long, stream_id int")
    points = analytics.with_update_markers(analytics.series(results), results, members)
    got = sorted((r.stream_id, r.seq, r.pos, r.pred, r.is_update) for r in points.collect())
    assert got == [(1, 0, 0, 1.0, False), (1, 0, 1, 2.0, False), (1, 1, 0, -1.0, True), (2, 1, 0, -1.0, True)]
    maxima = analytics.axis_maxima(results).first()
    assert (maxima.documents, maxima.max_value, maxima.max_loss) == (2, 4.0, 0.5)


def test_markers_are_dealt_to_tasks(spark, monkeypatch):
    """Few updates on many streams are many points; a task makes no more than its part of them."""
    monkeypatch.setattr(analytics, "MARK_ROWS", 1000, raising=False)
    schema = "model_id long, seq long, stream_id int, pred array<double>, true array<double>, loss double, average_loss double, ts timestamp, updated_at timestamp"
    results = spark.createDataFrame([(0, i, None, None, None, None, None, None, START) for i in range(100)], schema).coalesce(1)
    members = spark.range(100).select(F.lit(0).cast("long").alias("model_id"), F.col("id").cast("int").alias("stream_id"))
    points = analytics.with_update_markers(analytics.series(results), results, members).where("is_update")
    sizes = [r["count"] for r in points.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) >= 5 and max(sizes) <= 3000
    assert points.distinct().count() == 10_000


def test_markers_of_very_many_streams_are_dealt_to_tasks(spark, monkeypatch):
    """Streams beyond the limit of a broadcast are dealt; no task makes all points of a model."""
    monkeypatch.setattr(analytics, "MARK_ROWS", 50_000)
    n = 1_100_000
    schema = "model_id long, seq long, stream_id int, pred array<double>, true array<double>, loss double, average_loss double, ts timestamp, updated_at timestamp"
    results = spark.createDataFrame([(m, i, None, None, None, None, None, None, START) for m, i in [(0, 0), (0, 1), (1, 0), (2, 0)]], schema)
    members = spark.range(n).select((F.col("id") % 2).alias("model_id"), F.col("id").cast("int").alias("stream_id"))
    points = analytics.with_update_markers(analytics.series(results), results, members).where("is_update")
    sizes = [r["count"] for r in points.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3 * n // 2 and len(sizes) >= 20 and max(sizes) <= 150_000
    assert points.select("model_id", "seq", "stream_id").distinct().count() == 3 * n // 2


@pytest.mark.parametrize("bad", ["huber"])
def test_unknown_loss(bad):
    with pytest.raises(ValueError):
        scoring.loss(bad)
