"""Repeated substrings by refining buckets of sampled suffixes.

Which bytes lie in a string of ``length`` bytes that also starts elsewhere is found without a suffix array of
all positions. Of every ``length`` bytes, the q-gram with the smallest hash is an anchor, so equal strings have
equal anchors at the same place, and about one position in 64 is one. The strings with one anchor form a
run. Anchors start in the bucket of their q-gram; those alone in it are done. The others are refined by the
bucket identifiers of q-grams at further offsets, which together cover the whole stretch of the run:

* runs with the same identifiers repeat as a whole,
* runs alone in their bucket repeat nowhere,
* of a bucket that falls into several kinds of runs, one of each kind is cut into shorter runs, whose buckets are
  refined in the same way with longer common parts, until each run is one string.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Roller, Scratch, append, column, frugal, mix, row_blocks, text_buffer

LENGTH = 200
LEVELS = (7, 4, 0)
BLOCK = 2 << 20
SEEN = 500_000
NODE = "core long, hull long, tid long, anchor long, first long, n int"


def gram_bytes(length: int) -> int:
    """Size of the q-grams: every string has as many of them as a run of the first level can have strings."""
    return length - (1 << LEVELS[0]) + 1


def covered(names: np.ndarray, first: np.ndarray, last: np.ndarray, q: int, seed: np.ndarray) -> np.ndarray:
    """Name of the bytes from ``first`` to q bytes after ``last``, from the bucket identifiers that cover them.

    The number of identifiers is that of the longest run, so that names do not depend on what is named together.
    """
    out = mix(seed.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    for k in range(2 * (1 << LEVELS[0]) // q + 2):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + names[np.minimum(first + k * q, last)])
    return out


def root_runs(names: np.ndarray, data_ends: np.ndarray, q: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last string of each run; ``data_ends`` has the end of the text at each position."""
    low = np.uint64((1 << 24) - 1)
    least = (names & ~low) | np.arange(len(names), dtype=np.uint64)
    for shift in range(LEVELS[0]):
        least = np.minimum(least[: -(1 << shift)], least[1 << shift :])
    anchor = (least & low).astype(np.int64)
    at = np.flatnonzero(np.arange(len(anchor)) + length <= data_ends[: len(anchor)])
    if not len(at):
        return at, at, at
    anchor = anchor[at]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(anchor) != 0)]))
    last = np.append(new[1:], len(at)) - 1
    return anchor[new], at[new], at[last]


def roots(docs: DataFrame, length: int) -> DataFrame:
    """Runs of the first level of all texts (``tid``, ``text``); a task sends those of equal texts twice at most."""
    q = gram_bytes(length)

    def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
        """Row range, bytes, ends of the rows and begin of blocks of rows, or of overlapping parts of a long row."""
        for first, last in row_blocks(offsets, BLOCK):
            begin, end = int(offsets[first]), int(offsets[last])
            for at in range(begin, max(begin + 1, end - length + 1), BLOCK) if last - first == 1 else [begin]:
                stop = min(end, at + BLOCK + length - 1) if last - first == 1 else end
                yield first, last, data[at:stop], at, stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        seen: dict[int, int] = {}
        for batch in batches:
            tids = column(batch, "tid").to_numpy(zero_copy_only=False)
            fresh = np.zeros(len(tids), bool)
            for row, tid in enumerate(tids.tolist()):
                if len(seen) >= SEEN:
                    seen.clear()
                seen[tid] = times = seen.get(tid, 0) + 1
                fresh[row] = times <= 2
            batch = batch.filter(pa.array(fresh))
            tids = tids[fresh]
            data, offsets = text_buffer(column(batch, "text"))
            for first, last, part, begin, _ in pieces(data, offsets):
                if len(part) < length:
                    continue
                bounds = np.clip(offsets[first : last + 1] - begin, 0, len(part))
                names = roller.grams(roller.prefix(part), q)
                anchor, lo, hi = root_runs(names, np.repeat(bounds[1:], np.diff(bounds)), q, length)
                if not len(lo):
                    continue
                row = np.searchsorted(offsets, lo + begin, "right") - 1
                shift = begin - offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mix(names[anchor]).view(np.int64)),
                        pa.array(covered(names, lo, hi + (length - q), q, (anchor - lo) << 8 | (hi - lo)).view(np.int64)),
                        pa.array(tids[row]),
                        pa.array(anchor + shift),
                        pa.array(lo + shift),
                        pa.array((hi - lo + 1).astype(np.int32)),
                    ],
                    ["core", "hull", "tid", "anchor", "first", "n"],
                )

    return docs.select("tid", "text").mapInArrow(frugal(run), NODE)


def split_runs(
    names: np.ndarray, anchor: np.ndarray, first: np.ndarray, n: np.ndarray, level: int, q: int, length: int
) -> tuple[np.ndarray, ...]:
    """Cut runs at offsets from the anchor divisible by ``2**level``; core, hull, anchor, first and n of each part."""
    width = 1 << level
    low, high = (anchor - first - n + 1) >> level, (anchor - first) >> level
    parts = high - low + 1
    back = np.repeat(np.arange(len(anchor)), parts)
    block = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + low[back]
    anchor, first, last = anchor[back], first[back], (first + n - 1)[back]
    near, far = anchor - block * width, anchor - block * width - width + 1
    lo, hi = np.maximum(first, far), np.minimum(last, near)
    core = covered(names, near, far + (length - q), q, block)
    hull = covered(names, lo, hi + (length - q), q, (anchor - lo) << 8 | (hi - lo))
    return core, hull, anchor, lo, hi - lo + 1


def parts(docs: DataFrame, wanted: DataFrame, level: int, length: int) -> DataFrame:
    """Runs of the next level: the undecided ones (``tid, runs``) cut into shorter ones.

    One copy of a text is enough, as what its copies repeat has been found before; those that follow each other
    are passed over.
    """
    q = gram_bytes(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, previous = Roller(), None
        for batch in batches:
            data, offsets = text_buffer(column(batch, "text"))
            runs = column(batch, "runs")
            for row, tid in enumerate(column(batch, "tid").to_pylist()):
                if tid == previous:
                    continue
                previous = tid
                flat = runs[row].values
                anchor, first, n = (flat.field(c).to_numpy().astype(np.int64) for c in ("anchor", "first", "n"))
                order = np.argsort(first, kind="stable")
                anchor, first, n = anchor[order], first[order], n[order]
                # neighbouring runs are taken together, so that a long text is never hashed as a whole
                reach = np.maximum.accumulate(first + n + length)
                cuts = np.flatnonzero(np.concatenate([[True], first[1:] - reach[:-1] > 4 * length]))
                for i, j in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
                    begin = int(first[i])
                    names = roller.grams(roller.prefix(data[offsets[row] + begin : offsets[row] + int(reach[j - 1])][: reach[j - 1] - begin]), q)
                    made = split_runs(names, anchor[i:j] - begin, first[i:j] - begin, n[i:j], level, q, length)
                    core, hull, at, lo, count = made
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(core.view(np.int64)),
                            pa.array(hull.view(np.int64)),
                            pa.array(np.full(len(core), tid, np.int64)),
                            pa.array(at + begin),
                            pa.array(lo + begin),
                            pa.array(count.astype(np.int32)),
                        ],
                        ["core", "hull", "tid", "anchor", "first", "n"],
                    )

    packed = wanted.groupBy("tid").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("runs"))
    texts = docs.select("tid", "text").join(packed, "tid")
    return texts.select("tid", "text", "runs").mapInArrow(frugal(run), NODE)


def decided(runs: DataFrame, scratch: Scratch, level: int) -> tuple[DataFrame, DataFrame]:
    """Of the runs of a level: those that repeat as a whole, and one of each kind in buckets of several kinds."""
    # sides of joins are written first: what has just been aggregated by the key could not be split where it is hot
    sizes = runs.groupBy("core").agg(F.count("*").alias("in_core")).where("in_core > 1").select("core")
    shared = scratch.write(runs.join(scratch.write(sizes, f"cores{level}"), "core"), f"shared{level}")
    kinds = shared.groupBy("core", "hull").agg(
        F.count("*").alias("times"), F.first("tid").alias("tid"), F.first("anchor").alias("anchor"),
        F.first("first").alias("first"), F.first("n").alias("n"),
    )
    kinds = scratch.write(kinds, f"kinds{level}")
    several = scratch.write(kinds.where("times > 1").select("core", "hull"), f"several{level}")
    whole = shared.join(several, ["core", "hull"])
    mixed = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    mixed = scratch.write(mixed, f"mixed{level}")
    rest = kinds.join(mixed, "core").select("tid", "anchor", "first", "n")
    return whole.select("tid", "first", "n").distinct(), rest


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of overlapping or touching ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[new], ends[np.append(new[1:], len(starts)) - 1]


def spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``tid`` and the repeated byte ranges ``spans`` of each text of ``docs`` (tid, text) that has any."""
    found = None
    runs = scratch.write(roots(docs, length), "roots")
    for k, level in enumerate(LEVELS):
        whole, rest = decided(runs, scratch, level)
        whole = scratch.write(whole, f"whole{level}")
        found = whole if found is None else found.union(whole)
        rest = scratch.write(rest, f"rest{level}") if level else rest
        scratch.drop("roots" if k == 0 else f"runs{level}")
        scratch.drop(*(f"{name}{level}" for name in ("cores", "shared", "kinds", "several", "mixed")))
        if level == 0:
            break
        following = LEVELS[k + 1]
        runs = scratch.write(parts(docs, rest, following, length), f"runs{following}")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        for row in column(batch, "runs"):
            first, n = (row.values.field(c).to_numpy().astype(np.int64) for c in ("first", "n"))
            starts, ends = merge(first, first + n - 1 + length)
            out.append([{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {"spans": pa.array(out, kind)}

    grouped = found.groupBy("tid").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    merged = append(grouped, "spans array<struct<start:bigint,end:bigint>>", run, ["tid"])
    merged = scratch.write(merged, "spans")
    scratch.drop(*(f"{name}{level}" for name in ("whole", "rest") for level in LEVELS))
    return merged


def with_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, name: str = "spans") -> DataFrame:
    """``docs`` with a column ``name`` (start, end): the byte ranges of the UTF-8 text, in order, that the operator removes.

    A byte is in a span if it lies in a string of ``length`` bytes that also starts at another place of any row,
    the same one included. Null and shorter texts have no spans (null); copies of a row count as other
    rows. A column of that name is replaced, all others are kept.
    """
    docs = docs.drop(name).withColumn("__tid", F.xxhash64(F.lit(7), text))
    texts = docs.where(F.octet_length(text) >= length).select(F.col("__tid").alias("tid"), F.col(text).alias("text"))
    found = spans(texts, Scratch(docs.sparkSession, "repeats"), length)
    found = found.select(F.col("tid").alias("__tid"), F.col("spans").alias(name))
    return docs.join(found, "__tid", "left").drop("__tid")


def kept_bytes(data: bytes, ranges: list[dict] | None) -> bytes:
    at, out = 0, []
    for span in ranges or []:
        out.append(data[at : span["start"]])
        at = span["end"]
    out.append(data[at:])
    return b"".join(out)


def removal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: bytes, bytes and runs removed, and SHA-256 (hex) of the bytes left."""

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values = column(batch, text).cast(pa.large_binary()).to_pylist()
        ranges = column(batch, "spans").to_pylist()
        left = [sha256(kept_bytes(v or b"", r)).hexdigest() for v, r in zip(values, ranges, strict=True)]
        return {
            "n_bytes": pa.array([len(v or b"") for v in values], pa.int64()),
            "n_removed": pa.array([sum(s["end"] - s["start"] for s in r or []) for r in ranges], pa.int64()),
            "n_spans": pa.array([len(r or []) for r in ranges], pa.int64()),
            "kept_sha256": pa.array(left, pa.string()),
        }

    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return append(with_repeats(docs.select(key, text), text, length), fields, add, [key], text)


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, and ``n_chars`` (if there) counted anew.

    What a cut leaves of a character is dropped. A row of which nothing but white space is left goes; a row that
    nothing was taken from stays as it is.
    """
    marked = with_repeats(docs, text, length, "__spans")

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values, ranges = column(batch, text), column(batch, "__spans").to_pylist()
        out = [
            v.as_py() if not r else kept_bytes(v.as_py().encode(), r).decode("utf-8", "ignore")
            for v, r in zip(values, ranges, strict=True)
        ]
        gone = [bool(r) and not left.strip() for left, r in zip(out, ranges, strict=True)]
        return {text: pa.array(out, pa.string()), "__gone": pa.array(gone, pa.bool_())}

    left = append(marked, f"`{text}` string, __gone boolean", add, by=text).where("not __gone")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)
