import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from onlinecast.llm import lattice
from onlinecast.llm.queries import op9_lattice
from tests.llm.frames import SMALL, clashing, none_of

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """Links and components of rows (id, vector, label), ids unique."""
    unit = {}
    for i, v, label in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        unit[i] = (label, x / np.linalg.norm(x))
    links = {i: set() for i, _, _ in rows}
    for i, (a, x) in unit.items():
        for j, (b, y) in unit.items():
            if i != j and a == b and len(x) == len(y) and x @ y >= cosine:
                links[i].add(j)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 8)) * 2
    found = lattice.decode_e8(x) / 2
    assert (np.abs(found * 2 - np.rint(found * 2)) < 1e-9).all()
    assert ((found.sum(1) % 2) == 0).all()
    around = lattice._shortest() / 2
    assert len(around) == 240 and np.allclose((around**2).sum(1), 2)
    best = ((x - found) ** 2).sum(1)
    assert (((x[:, None] - found[:, None] - around) ** 2).sum(2) >= best[:, None] - 1e-9).all()


def grouped(seed, n, size=64):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        if k % 3 or not rows:
            v = rng.normal(size=size)
        else:
            v = np.array(rng.choice(len(rows)) and rows[rng.integers(len(rows))][1]) + rng.normal(size=size) * rng.choice([0.0, 0.05, 0.15])
        rows.append((k * 5 % n if math.gcd(5, n) == 1 else k, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    return rows


@pytest.mark.parametrize("seed,size", [(0, 64), (1, 16), (2, 5)])
def test_against_brute_force(spark, seed, size):
    rows = grouped(seed, 301, size)
    want = brute(rows)
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(frame).collect()}
    true, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert found <= true
    assert found >= 0.99 * true
    assert all(got[i][0] <= want[i][0] for i in want)
    if found == true:
        assert got == want


def test_full_cells_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 7)
    rng = np.random.default_rng(4)
    base = rng.normal(size=64)
    rows = [(k, [float(np.float32(x)) for x in base + rng.normal(size=64) * 0.08], 1) for k in range(60)]
    rows += [(100 + k, rows[0][1], 1) for k in range(40)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    want = brute(rows)
    assert {i: (n, c, i == c) for i, (n, c) in want.items()} == got


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in op9_lattice(spark, SMALL).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0] * 4, 1), (4, [1.0, nan, 0.0, 0.0], 1), (5, [inf, 1.0, 0.0, 0.0], 1),
        (6, [1.0, None, 0.0, 0.0], 1), (7, one, None), (8, one, 1), (9, one, 1), (10, one, 2), (11, one[:3], 1),
        (12, [x * 1e30 for x in one], 1), (13, [-x for x in one], 1), (14, [0.0] * 4, 1),
    ]
    frame = clashing(spark.createDataFrame(rows, VECTORS), "class", "links", "kept", "key")
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_duplicates(frame).collect()}
    assert got == brute(rows)
    assert got[8] == (2, 8) and got[10] == (0, 10)
    assert lattice.near_duplicates(none_of(frame)).count() == 0
    more = spark.createDataFrame([(8, one, 1), (8, one, 1), (None, one, 1)], VECTORS)
    rows = lattice.near_duplicates(more).orderBy(F.col("vec_id").asc_nulls_first()).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows] == [
        (None, 2, 8, False), (8, 2, 8, True), (8, 2, 8, True),
    ]


def test_recall_by_probes():
    """The cells a vector visits beside its own find what one cell misses."""
    rng = random.Random(0)
    gen = np.random.default_rng(rng.randrange(100))
    a = lattice.unit(gen.normal(size=(400, 64)))
    b = lattice.unit(a + gen.normal(size=a.shape) * 0.02)
    assert ((a * b).sum(1) > 0.98).all()
    near = lattice._shortest()
    matrix = lattice.projection(64, 0, 0.98)
    ca, cb = lattice.decode_e8(a @ matrix), lattice.decode_e8(b @ matrix)
    same = (ca == cb).all(1)
    visits = np.argsort(-(a @ matrix - ca / 2) @ near.T, axis=1)[:, : lattice.PROBES]
    met = same | ((ca[:, None] + near[visits]) == cb[:, None]).all(2).any(1)
    assert met.mean() > 0.95 > same.mean()
