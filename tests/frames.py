"""Small frames with a stream that holds most of the rows, bursts and equal times."""

import datetime as dt

import numpy as np

START = dt.datetime(2024, 1, 1)


def readings(spark, seed=0, hot=400, others=6):
    """Stream 0 has ``hot`` readings, a third of them at one instant; the others have few."""
    rng = np.random.default_rng(seed)
    rows, event = [], 0
    for stream, n in [(0, hot)] + [(s, int(rng.integers(0, 25))) for s in range(1, others + 1)]:
        at = np.sort(rng.integers(0, 10_000, n))
        at[n // 3 : 2 * n // 3] = at[n // 3] if n else 0
        for t in np.sort(at):
            rows.append((stream, START + dt.timedelta(seconds=int(t)), event, float(rng.integers(0, 1000)) / 10))
            event += 1
    order = rng.permutation(len(rows))
    return spark.createDataFrame([rows[i] for i in order], "stream_id int, ts timestamp, event_id long, value double")


def same(left, right):
    a = left.select(*sorted(left.columns)).collect()
    b = right.select(*sorted(right.columns)).collect()
    assert len(a) > 0
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def near(left, right, keys, value, tolerance=1e-9):
    a = {tuple(r[k] for k in keys): r[value] for r in left.collect()}
    b = {tuple(r[k] for k in keys): r[value] for r in right.collect()}
    assert a.keys() == b.keys() and a
    for key in a:
        assert (a[key] is None) == (b[key] is None), key
        assert a[key] is None or abs(a[key] - b[key]) <= tolerance * max(1, abs(b[key])), (key, a[key], b[key])
