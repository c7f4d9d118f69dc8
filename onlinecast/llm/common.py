"""What the operators share: text buffers of Arrow batches, word positions, hashes, columns added row by row."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onlinecast.plans.tables import delete, new_path, size_bound

BLOCK_BYTES = 4 << 20
ODD = 0x9E3779B97F4A7C15


def give_back() -> None:
    """Return memory that was freed to the system, as a Python worker outlives its task and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, for ``mapInArrow``; what it freed is given back at the end of the task."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def append(
    df: DataFrame,
    fields: str,
    add: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    keep: list[str] | None = None,
    by: str | None = None,
) -> DataFrame:
    """``df`` with the columns that ``add`` makes of each Arrow batch; a column of the same name is replaced.

    ``by`` names a text column: batches are then cut into slices of ``BLOCK_BYTES`` of it (or one row).
    """
    new = T.StructType.fromDDL(fields)
    names = new.fieldNames()
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*[df.schema[c] for c in kept], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            slices = row_blocks(text_buffer(column(whole, by))[1]) if by else [(0, len(whole))]
            for first, last in slices:
                batch = whole.slice(first, last - first)
                made = add(batch)
                arrays = [column(batch, c) for c in kept] + [made[n] for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])
            whole = batch = made = arrays = None
            give_back()

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffer(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column of texts and the n + 1 offsets of its rows; a null is an empty text."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of a known 64-bit hash)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class Roller:
    """Hashes of any substring of a byte block from one prefix sum modulo 2**64."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**62, 2**63, dtype=np.uint64)) * 2 + 1
        self.back = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.back, size, 2**64))])

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of the block; entry i covers the bytes before i."""
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def grams(self, sums: np.ndarray, q: int) -> np.ndarray:
        """Hash of the q bytes from each position on."""
        n = max(0, len(sums) - q)
        return mix((sums[q:] - sums[:n]) * self.down[:n]) if n else np.zeros(0, np.uint64)


def runs_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def words_of(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each maximal run of bytes that ``word`` (256 flags) accepts; no run crosses rows."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = word[data]
    starts = inside[:-1] & ~np.concatenate([[False], inside[:-2]])
    cuts = offsets[:-1][(offsets[:-1] < offsets[-1]) & (offsets[1:] > offsets[:-1])]
    starts[cuts] = inside[cuts]
    first = np.flatnonzero(starts)
    ends = inside[:-1] & ~inside[1:]
    ends[cuts[cuts > 0] - 1] = inside[cuts[cuts > 0] - 1]
    last = np.flatnonzero(ends) + 1
    return np.searchsorted(offsets, first, "right") - 1, first, last


def remainder_of(id_column: str, modulus: int):
    """crc32 of the id as text modulo ``modulus``; null ids have none."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(modulus))


class Scratch:
    """Tables of one call in the folder all executors share; they cut lineage and can be dropped one by one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, new_path(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete(self.spark, f"{self.root}/{name}")


def small_side(df: DataFrame, limit: int = 16 << 20) -> DataFrame:
    """``df``, to be broadcast if all its rows together are within ``limit`` bytes, else as it is."""
    return F.broadcast(df) if size_bound(df) <= limit else df
