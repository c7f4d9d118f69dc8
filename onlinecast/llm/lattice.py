"""Near-duplicate vectors by lattice hashing.

A few random projections to eight dimensions are decoded to the nearest point of the E8 lattice, one table
each. A vector stands in the cell of its point and visits the cells around it that are nearest to what decoding
left over. Vectors that meet in a cell are compared by cosine in double precision, in blocks of a bounded
number of vectors, so neither a full cell nor all pairs of a group ever pass through one task or become
rows: a block returns how many links each vector has and the smallest vector it leads to. A pair that meets more
than once counts at its first meeting only, which both sides can tell from the cells they carry along.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Scratch, append, column
from onlinecast.llm.components import components

COSINE = 0.98
TABLES = 3
PROBES = 12
SEED = 11
BLOCK = 1024


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    units = np.eye(8, dtype=np.int64) * 2
    sums = [s * units[i] + t * units[j] for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    halves = [np.array(v) for v in itertools.product((1, -1), repeat=8) if np.prod(v) == 1]
    return np.array(sums + halves)


def _places(shortest: np.ndarray) -> np.ndarray:
    """Index of a shortest vector from its digits in base 5."""
    place = np.full(5**8, -1, np.int16)
    place[((shortest + 2) * 5 ** np.arange(8)).sum(1)] = np.arange(len(shortest))
    return place


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice point of each row, doubled: the better of those with whole and with half coordinates."""

    def even(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        odd = np.flatnonzero(near.sum(1).astype(np.int64) % 2)
        worst = np.abs(y - near)[odd].argmax(1)
        near[odd, worst] += np.where(y[odd, worst] >= near[odd, worst], 1, -1)
        return near

    whole, half = even(x), even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return (2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


def projection(size: int, table: int, cosine: float) -> np.ndarray:
    """From ``size`` to 8 dimensions, stretched so that vectors at the threshold are well within a cell of each other."""
    normal = np.random.default_rng([SEED, size, table]).normal(size=(size, 8))
    stretch = 1.2 / np.sqrt(2 - 2 * cosine)
    if size < 8:
        return normal * stretch / 8
    return np.linalg.qr(normal)[0] * stretch * np.sqrt(size) / 8


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def hashed(distinct: DataFrame, tables: int, probes: int, cosine: float) -> DataFrame:
    """Add to every vector its ``cells`` (doubled coordinates), the directions it ``visits``, and the keys of both."""
    shortest = _shortest()

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        lists = column(batch, "embedding")
        sizes = np.diff(np.asarray(lists.offsets))
        n = len(lists)
        cells, visits = np.zeros((n, tables, 8), np.int64), np.zeros((n, tables, probes), np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            flat = pa.concat_arrays([lists[int(r)].values for r in rows]).to_numpy(zero_copy_only=False).astype(float)
            x = unit(flat.reshape(-1, size))
            for t in range(tables):
                y = x @ projection(int(size), t, cosine)
                cells[rows, t] = point = decode_e8(y)
                visits[rows, t] = np.argsort(-(y - point / 2) @ shortest.T, axis=1, kind="stable")[:, :probes]
        around = np.concatenate([cells[:, :, None, :], cells[:, :, None, :] + shortest[visits]], axis=2)
        keys = [[";".join(map(str, [t, *map(int, c)])) for t in range(tables) for c in around[r, t]] for r in range(n)]
        return {
            "cells": pa.array([c.astype("<i2").tobytes() for c in cells], pa.binary()),
            "visits": pa.array([v.astype(np.uint8).tobytes() for v in visits], pa.binary()),
            "keys": pa.array(keys, pa.list_(pa.string())),
        }

    return append(distinct, "cells binary, visits binary, keys array<string>", add)


def meetings(vectors: DataFrame, probes: int, scratch: Scratch) -> DataFrame:
    """A row for each cell a vector stands in or visits (where one stands), dealt to blocks of the cell's pairs."""
    cell = F.posexplode("keys").alias("at", "key")
    met = vectors.select("label", "size", "class", cell).select(
        "label", "size", "class", F.xxhash64("key").alias("cell"), F.floor(F.col("at") / (probes + 1)).cast("int").alias("table"),
        (F.col("at") % (probes + 1) == 0).alias("home"),
    )
    met = scratch.write(met, "met")
    keys = ["label", "size", "table", "cell"]
    full = met.groupBy(*keys).agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("n"))
    full = full.where("homes > 0 and n > 1").select(*keys, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = met.join(full, keys).withColumn("own", own).withColumn("other", other)
    return dealt.select(
        *keys, "class", "home", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )


def linked_pairs(dealt: DataFrame, vectors: DataFrame, probes: int, cosine: float) -> DataFrame:
    """``class``, ``links`` (rows linked) and ``least`` (smallest class reached) of each vector in each block."""
    place = _places(_shortest())

    def visited(cells: np.ndarray, visits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a visits the cell of b."""
        way = cells[b] - cells[a]
        near = (np.abs(way) <= 2).all(1)
        index = np.where(near, place[(np.where(near[:, None], way + 2, 0) * 5 ** np.arange(8)).sum(1)], -1)
        return (visits[a] == index[:, None]).any(1) & (index >= 0)

    def compare(table: pa.Table) -> pa.Table:
        names = table.column("class").to_numpy()
        copies = table.column("copies").to_numpy()
        home, own = table.column("home").to_numpy(), table.column("own").to_numpy()
        t, low, high = (table.column(c)[0].as_py() for c in ("table", "low", "high"))
        n = len(names)
        x = unit(np.array(table.column("embedding").to_pylist(), float))
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind).astype(np.int64)
        cells, visits = joined("cells", "<i2").reshape(n, -1, 8), joined("visits", np.uint8).reshape(n, -1, probes)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        i, j = np.nonzero(x[left] @ x[right].T >= cosine)
        a, b = left[i], right[j]
        keep = (home[a] | home[b]) & (names[a] != names[b]) & ((a < b) if low == high else True)
        a, b = a[keep], b[keep]
        # a pair counts where it meets first: in an earlier table, in the cell of both, in that of the smaller one's visit
        first = np.ones(len(a), bool)
        for u in range(t):
            same = (cells[a, u] == cells[b, u]).all(1)
            here = visited(cells[:, u], visits[:, u], a, b) | visited(cells[:, u], visits[:, u], b, a)
            first &= ~(same | here)
        guest, host = np.where(home[a], b, a), np.where(home[a], a, b)
        both = home[a] & home[b]
        back = visited(cells[:, t], visits[:, t], host, guest)
        first &= both | ~back | (names[guest] < names[host])
        a, b = a[first], b[first]
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        least = names.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, a, before[b])
            np.minimum.at(least, b, before[a])
            if (least == before).all():
                break
        some = links > 0
        return pa.table({"class": names[some], "links": links[some].astype(np.int64), "least": least[some]})

    info = vectors.select("class", "label", "size", "copies", "embedding", "cells", "visits")
    rows = dealt.join(info, ["class", "label", "size"])
    groups = rows.groupBy("label", "size", "table", "cell", "low", "high")
    return groups.applyInArrow(compare, "class long, links long, least long")


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
    cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows with equal labels and sizes link when the cosine of their vectors is at least ``cosine`` and they meet in
    a cell; none links below it. Rows without label, and vectors that are null, empty, zero or hold a null or a
    number that is not finite, link with nothing. Equal vectors are compared once and count as often as they
    stand there. ``component_id`` is the smallest key that links lead to, the row's own included; a row without
    key counts as a link, but gives no name. ``kept`` says that they are the same. Other columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession, "lattice")
    rows = vectors.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("label").isNotNull() & F.exists("embedding", lambda v: v != 0) & ~odd
    name = F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "embedding"))
    rows = rows.withColumn("class", name)
    distinct = rows.where(F.col("class").isNotNull()).groupBy("label", "class").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("key").alias("least_key")
    )
    distinct = scratch.write(hashed(distinct.withColumn("size", F.size("embedding")), tables, probes, cosine), "vectors")
    found = scratch.write(linked_pairs(meetings(distinct, probes, scratch), distinct, probes, cosine), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("class").alias("u"), F.col("least").alias("v")))
    named = distinct.select("class", "copies", "least_key").join(links, "class", "left")
    named = named.join(parts.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("least_key").alias("component_id"))
    named = named.join(least, "component").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("key", "class").join(scratch.write(named, "named"), "class", "left")
    scratch.drop("met", "vectors", "links")
    component = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"),
    )
