"""Toxicity by a factorization machine over hashed terms.

A document is the set of its lower-case terms, hashed to ``2**BITS`` features. The machine adds to the linear
weights a product of two short vectors for every pair of terms, so a pair can say what its terms do not
(an insult next to the mention of a group). It is fitted on a bounded sample of labelled rows in one task;
scoring is one pass over all texts, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Roller, append, column, frugal, remainder_of, row_blocks, text_buffer, words_of

BITS = 18
RANK = 4
SAMPLE = 4_000
EPOCHS = 15
TOXIC_WEIGHT = 4.0
SEEN_SHARE = 0.001

LETTERS = np.zeros(256, bool)
LETTERS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
LETTERS[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def term_sets(data: np.ndarray, offsets: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of every distinct term of the rows, in order of the rows."""
    lowered = LOWER[data]
    rows, starts, ends = words_of(lowered, offsets, LETTERS)
    if not len(rows):
        return rows, rows
    feature = roller.spans(roller.prefix(lowered), starts, ends) >> np.uint64(64 - BITS)
    keys = np.unique((rows.astype(np.uint64) << np.uint64(BITS)) | feature)
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64(2**BITS - 1)).astype(np.int64)


def features_of(values: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of rows: their number, and row and feature of each term."""
    roller = Roller()
    data, offsets = text_buffer(values)
    for first, last in row_blocks(offsets):
        begin, end = offsets[first], offsets[last]
        yield last - first, *term_sets(data[begin:end], offsets[first : last + 1] - begin, roller)


class FactorizationMachine:
    """Logistic model of a bias, a weight for each feature and products of vectors for each pair of features."""

    def __init__(self, bits: int = BITS, rank: int = RANK):
        self.bias = 0.0
        self.weights = np.zeros(2**bits, np.float32)
        self.vectors = np.zeros((2**bits, rank), np.float32)

    def margins(self, n: int, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        live = self.weights[features] != 0
        live |= self.vectors[features].any(axis=1)
        rows, features = rows[live], features[live]
        out = self.bias + np.bincount(rows, self.weights[features], n)
        v = self.vectors[features]
        for f in range(v.shape[1]):
            out += 0.5 * (np.bincount(rows, v[:, f], n) ** 2 - np.bincount(rows, v[:, f] ** 2, n))
        return out

    def fit(
        self, indptr: np.ndarray, features: np.ndarray, toxic: np.ndarray, importance: np.ndarray,
        epochs: int = EPOCHS, rate: float = 0.3, sparsity: float = 5e-4, seen: float = SEEN_SHARE, seed: int = 7,
    ) -> FactorizationMachine:
        """Proximal adaptive steps on the logistic loss; features in less than this share of the rows (or one) keep 0."""
        rng = np.random.default_rng(seed)
        used, features = np.unique(features, return_inverse=True)
        common = np.bincount(features, minlength=len(used)) >= max(2, seen * len(toxic))
        n, m, rank = len(toxic), len(used), self.vectors.shape[1]
        w, v, bias = np.zeros(m), rng.normal(0, 0.02, (m, rank)), 0.0
        w_sum, v_sum, b_sum = np.full(m, 1e-2), np.full((m, rank), 1.0), 1e-2
        lengths = np.diff(indptr)
        rows = np.repeat(np.arange(n), lengths)
        keep = common[features]
        rows, features = rows[keep], features[keep]
        indptr = np.searchsorted(rows, np.arange(n + 1))
        size = max(16, min(256, n // 20 + 1))
        for _ in range(epochs):
            order = rng.permutation(n)
            for part in range(0, n, size):
                chosen = order[part : part + size]
                counts = indptr[chosen + 1] - indptr[chosen]
                where = np.repeat(np.arange(len(chosen)), counts)
                at = np.arange(counts.sum()) + np.repeat(indptr[chosen] - np.cumsum(counts) + counts, counts)
                f = features[at]
                vf = v[f]
                sums = np.stack([np.bincount(where, vf[:, k], len(chosen)) for k in range(rank)], 1)
                squares = np.bincount(where, (vf**2).sum(1), len(chosen))
                margin = bias + np.bincount(where, w[f], len(chosen)) + 0.5 * ((sums**2).sum(1) - squares)
                gap = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[chosen]) * importance[chosen] / len(chosen)
                touched = np.unique(f)
                gw = np.bincount(f, gap[where], m)[touched]
                gv = np.stack([np.bincount(f, gap[where] * (sums[where, k] - vf[:, k]), m)[touched] for k in range(rank)], 1)
                b_sum += gap.sum() ** 2
                bias -= rate * gap.sum() / np.sqrt(b_sum)
                w_sum[touched] += gw**2
                step = rate / np.sqrt(w_sum[touched])
                moved = w[touched] - step * gw
                w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
                v_sum[touched] += gv**2
                step = 0.5 * rate / np.sqrt(v_sum[touched])
                moved = v[touched] - step * gv
                v[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
        self.bias = float(bias)
        self.weights[used] = np.where(common, w, 0)
        self.vectors[used] = np.where(common[:, None], v, 0)
        return self

    def packed(self) -> bytes:
        live = np.flatnonzero((self.weights != 0) | self.vectors.any(axis=1))
        return pickle.dumps((self.bias, live, self.weights[live], self.vectors[live]))

    @classmethod
    def unpacked(cls, blob: bytes) -> FactorizationMachine:
        model = cls()
        model.bias, live, weights, vectors = pickle.loads(blob)
        model.weights[live], model.vectors[live] = weights, vectors
        return model


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Text, label and importance of at most ``sample`` toxic and 2 * ``sample`` other labelled documents.

    The rows with the smallest hash of their id are taken, and weigh as many rows as they stand for (``fit`` weighs
    toxic ones ``TOXIC_WEIGHT`` times, as a missed one is worse). Documents
    whose crc32 of the id is divisible by 5 are held out; of contradicting labels the larger holds.
    """
    marked = (
        labels.where(F.col("toxic").isNotNull() & (remainder_of("doc_id", 5) != 0))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
    )
    counts = dict(marked.groupBy("__toxic").count().collect())
    picked = None
    for label, limit in ((1, sample), (0, 2 * sample)):
        some = marked.where(F.col("__toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        weight = max(1.0, counts.get(label, 0) / limit)
        some = some.withColumn("__weight", F.lit(weight))
        picked = some if picked is None else picked.union(some)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # picked: at most 3 * sample rows
    return rows.groupBy("doc_id").agg(
        F.max("text").alias("__text"), F.first("__toxic").alias("__toxic"), F.first("__weight").alias("__weight")
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> bytes:
    """Packed machine, fitted in one task on the bounded sample. Without labelled rows it scores everything 0."""

    def sets(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out: list[bytes] = []
        for n, rows, features in features_of(column(batch, "__text")):
            ends = np.searchsorted(rows, np.arange(n + 1))
            out += [features[i:j].astype("<i4").tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]
        return {"terms": pa.array(out, pa.binary())}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        model = FactorizationMachine()
        model.bias = -30.0
        if rows:
            rows.sort(key=lambda r: r["doc_id"])
            sets = [np.frombuffer(r["terms"], "<i4") for r in rows]
            indptr = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            toxic = np.array([r["__toxic"] for r in rows], float)
            weight = np.array([r["__weight"] for r in rows], float) * np.where(toxic > 0, TOXIC_WEIGHT, 1)
            model.fit(indptr, np.concatenate(sets).astype(np.int64), toxic, weight / weight.mean(), epochs)
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.packed()], pa.binary())})

    rows = append(labelled_sample(docs, labels, sample), "terms binary", sets, ["doc_id", "__toxic", "__weight"], "__text")
    return rows.repartition(1).mapInArrow(frugal(train), "model binary").first()[0]


def score(docs: DataFrame, model: bytes, text: str = "text", name: str = "score") -> DataFrame:
    """Add ``name`` (0 to 1, higher: likelier toxic) to every row; a null or empty text gets that of no terms.

    Each row is scored from its whole text alone. A column of that name is replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        machine = FactorizationMachine.unpacked(shared.value)
        parts = [machine.margins(n, rows, features) for n, rows, features in features_of(column(batch, text))]
        margins = np.concatenate([np.zeros(0), *parts])
        return {name: pa.array(1 / (1 + np.exp(-np.clip(margins, -500, 500))), pa.float64())}

    return append(docs, f"`{name}` double", add, by=text)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on).

    ``docs`` has doc_id and text, ``labels`` has doc_id and toxic. Rows are kept as they are, also repeated ones;
    rows without id are scored, but never learned from.
    """
    scored = score(docs, fit(docs, labels, sample))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that are likelier toxic than not."""
    scored = score(docs, fit(docs, labels, sample), name="__toxicity")
    return scored.where(F.col("__toxicity") < 0.5).select(*docs.columns)
