"""Language of a text by error-correcting output codes.

Every language has a codeword of bits, as far from the others as can be found. For each bit a binary
classifier over byte n-grams predicts whether a text's language has it. A text gets the language whose codeword
loses least against the predictions, each bit weighted by how well it was learned, so that some wrong bits
do not change the answer; a second codeword almost as near marks the answer as ambiguous.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import append, column, mix, remainder_of, row_blocks, text_buffer

BITS = 13
ORDERS = (1, 2, 3, 4)
SAMPLE = 4_000
STEPS = 80
AMBIGUOUS = 0.6

SPACE = 32
LETTERS = np.full(256, SPACE, np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


def has_letter(values: list[str | None]) -> np.ndarray:
    return np.array([value is not None and any(map(str.isalpha, value)) for value in values], bool)


def gram_counts(data: np.ndarray) -> np.ndarray:
    """Counts of the hashed n-grams of one text; what is no letter counts as one space."""
    marks = LETTERS[data]
    text = np.concatenate([[SPACE], marks, [SPACE]]).astype(np.uint64)
    text = text[np.concatenate([[True], (text[1:] != SPACE) | (text[:-1] != SPACE)])]
    total = np.zeros(2**BITS, np.float32)
    code = np.zeros(len(text), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        code = (code[: len(text) - order + 1] << np.uint64(8)) | text[order - 1 :] if order > 1 else text
        if order in ORDERS and len(code):
            slots = (mix(code + np.uint64(order << 40)) >> np.uint64(64 - BITS)).astype(np.int64)
            total += np.bincount(slots, minlength=2**BITS)
    return total


def features_of(values: pa.Array, block: int = 64) -> Iterator[np.ndarray]:
    """Square roots of the shares of the n-grams, for blocks of texts."""
    data, offsets = text_buffer(values)
    for first in range(0, len(values), block):
        last = min(first + block, len(values))
        out = np.zeros((last - first, 2**BITS), np.float32)
        for row in range(first, last):
            begin, end = offsets[row], offsets[row + 1]
            for part in range(begin, end, 1 << 20):
                out[row - first] += gram_counts(data[part : min(end, part + (1 << 20))])
        out /= np.maximum(out.sum(1, keepdims=True), 1)
        yield np.sqrt(out)


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """Codewords (+1, -1) of n classes: every split of up to seven, else the best of random ones."""
    if n <= 7:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.float32).T if splits else np.ones((n, 1), np.float32)
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (n, math.ceil(10 * math.log2(n))))
        code = code[:, np.abs(code.sum(0)) < n]
        nearest = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if nearest > apart:
            best, apart = code, nearest
    return best


class CodedClassifier:
    def __init__(self, languages: list[str]):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 1), np.float32)

    def fit(self, x: np.ndarray, language: np.ndarray, steps: int = STEPS, decay: float = 1e-4) -> CodedClassifier:
        """One logistic classifier for each bit, by accelerated gradient steps on rows weighted to equal languages."""
        target = self.code[language]
        weight = (1 / np.bincount(language, minlength=len(self.languages)))[language]
        weight = (weight / weight.sum())[:, None].astype(np.float32)
        rate = np.float32(4.0)
        self.weights = np.zeros((x.shape[1], target.shape[1]), np.float32)
        self.bias = np.zeros(target.shape[1], np.float32)
        speed, bias_speed = np.zeros_like(self.weights), np.zeros_like(self.bias)
        for _ in range(steps):
            ahead, bias_ahead = self.weights + 0.9 * speed, self.bias + 0.9 * bias_speed
            margin = x @ ahead + bias_ahead
            pull = -weight * target / (1 + np.exp(np.clip(target * margin, -30, 30)))
            speed = 0.9 * speed - rate * (x.T @ pull + decay * ahead)
            bias_speed = 0.9 * bias_speed - rate * pull.sum(0)
            self.weights, self.bias = self.weights + speed, self.bias + bias_speed
        right = (weight * (np.sign(x @ self.weights + self.bias) == target)).sum(0)
        self.trust = np.maximum(right - 0.5, 0.01).astype(np.float32)
        self.trust /= self.trust.sum()
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the nearest codeword and the probability that its loss stands for."""
        margin = x @ self.weights + self.bias
        losses = np.stack([(np.logaddexp(0, -margin * word) * self.trust).sum(1) for word in self.code], 1)
        chance = np.exp(len(self.trust) * (losses.min(1, keepdims=True) - losses))
        chance /= chance.sum(1, keepdims=True)
        return losses.argmin(1), chance.max(1)


def labelled_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most about ``sample`` labelled rows, as many of each language as there are or its share of ``sample``.

    Documents whose crc32 of the id leaves 2 modulo 4 are held out. Rows are taken by a hash of text and id.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder_of("doc_id", 4) != 2))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return known.select("doc_id", "text", "lang")
    share = max(1, sample // len(counts))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    bound = F.lit(0.0)
    for lang, n in counts:
        bound = F.when(F.col("lang") == lang, F.lit(1.5 * share / n)).otherwise(bound)
    near = known.where(draw < bound).select("doc_id", "text", "lang")
    return near.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample)


def fit(docs: DataFrame, sample: int = SAMPLE) -> bytes:
    """Packed classifier, fitted in one task on the bounded sample."""

    def grams(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [row.astype("<f2").tobytes() for x in features_of(column(batch, "text")) for row in x]
        return {"x": pa.array(rows, pa.binary())}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["x"]))
        taken: dict[str, int] = {}
        share = max(1, sample // max(1, len({r["lang"] for r in rows})))
        kept = []
        for row in rows:
            taken[row["lang"]] = taken.get(row["lang"], 0) + 1
            if taken[row["lang"]] <= share:
                kept.append(row)
        model = CodedClassifier(sorted(taken))
        if kept:
            x = np.stack([np.frombuffer(r["x"], "<f2") for r in kept]).astype(np.float32)
            model.fit(x, np.array([model.languages.index(r["lang"]) for r in kept]))
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(vars(model))], pa.binary())})

    rows = append(labelled_sample(docs, sample), "x binary", grams, ["doc_id", "lang"], "text")
    return rows.repartition(1).mapInArrow(train, "model binary").first()[0]


def predict(docs: DataFrame, model: bytes, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` to every row, from its whole text alone.

    A null text and one without letters get ``und``, 0.0 and true, and so does every text when no language was
    learned. Columns of these names are replaced, all others kept (or those that ``keep`` names).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        coded = CodedClassifier([])
        vars(coded).update(pickle.loads(shared.value))
        values = column(batch, text)
        known = has_letter(values.to_pylist())
        best, chance = np.zeros(len(values), np.int64), np.zeros(len(values))
        if coded.languages:
            done = 0
            for x in features_of(values):
                best[done : done + len(x)], chance[done : done + len(x)] = coded.decode(x)
                done += len(x)
        else:
            known[:] = False
        names = np.array([*coded.languages, "und"], object)[np.where(known, best, len(coded.languages))]
        score = np.where(known, chance, 0.0)
        return {
            "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(score, pa.float64()),
            "ambiguous": pa.array(score < AMBIGUOUS, pa.bool_()),
        }

    return append(docs, "lang_pred string, score double, ambiguous boolean", add, keep, text)
