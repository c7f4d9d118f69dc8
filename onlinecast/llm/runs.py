"""Periodic runs of words by online dyadic square catching.

Each document is read as a sequence of words. For every power of two ``m`` the blocks of ``m`` words that begin at
multiples of ``m / 2`` get a catcher once they are complete. Every further word advances the comparison of the words
that end there with the block of each open catcher, by one distance; a catcher closes at the first
distance at which its block returns. A distance ``q`` from ``m / 2`` on (below, a smaller block catches it) makes block
and return a repetition of period ``q``, and the smallest one, because it is the first. A stretch of length ``4 q`` or more
holds a whole block with its return for some multiple of ``m / 2``, so no run is missed. Catches
of neighbouring blocks with one period overlap by at least a period and merge into a run, whose ends
lie within half a block of the outer catches.

All catchers of a block size, over all documents of a slice, advance together. A block size costs as many
comparisons as there are words, so n words cost n log n.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import ODD, append, column, mix

MIN_LENGTH = 6
MIN_EXPONENT = 4
FOUND = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _starts(first: np.ndarray, last: np.ndarray, least: int, hop: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the blocks, at multiples of ``hop`` from each document's start and ``least`` words before its end, and those ends."""
    n = np.maximum(0, (last - first - least) // hop + 1)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first, n) + inner * hop, np.repeat(last, n)


def _caught(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that return first after more than half their size and at most their size, and that distance."""
    found: list[tuple[np.ndarray, int]] = []
    blocks = hashes[starts]
    for distance in range(1, size + 1):
        fits = starts + distance + size <= ends
        if not fits.all():
            starts, ends, blocks = starts[fits], ends[fits], blocks[fits]
        if not len(starts):
            break
        returned = hashes[starts + distance] == blocks
        if returned.any():
            if distance > size // 2:
                found.append((starts[returned], distance))
            starts, ends, blocks = starts[~returned], ends[~returned], blocks[~returned]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([s for s, _ in found])
    period = np.concatenate([np.full(len(s), d) for s, d in found])
    order = np.argsort(at)
    return at[order], period[order]


def _extended(ids: np.ndarray, at: np.ndarray, stop: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """Moves each end ``at`` word by word up to ``stop`` while the period holds."""
    at = at.copy()
    moving = np.flatnonzero(at != stop)
    while len(moving):
        here = at[moving] - (step < 0)
        other = here - step * period[moving]
        moving = moving[ids[here] == ids[other]]
        at[moving] += step
        moving = moving[at[moving] != stop[moving]]
    return at


def find_runs(
    ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run, by start and period; no run crosses ``bounds`` of documents.

    ``min_exponent`` is 4 or more: the catchers stand close enough together only from there on.
    """
    if min_exponent < 4:
        raise ValueError("runs of less than four periods are not all caught")
    nothing = (np.zeros(0, np.int64),) * 3
    first, last = bounds[:-1], bounds[1:]
    longest = int((last - first).max(initial=0))
    if longest < max(min_length, min_exponent):
        return nothing
    hashes = mix((ids.astype(np.uint64) + np.uint64(1)) * np.uint64(ODD))
    found = []
    size = 1
    while min_exponent * (size // 2 + 1) <= longest:
        hop, shortest = max(1, size // 2), max(min_length, min_exponent * (size // 2 + 1))
        long_enough = last - first >= shortest
        starts, ends = _starts(first[long_enough], last[long_enough], size + size // 2 + 1, hop)
        at, period = _caught(hashes, starts, ends, size)
        if len(at):
            document = np.searchsorted(bounds, at, "right")
            apart = np.flatnonzero((np.diff(at) != hop) | (np.diff(period) != 0) | (np.diff(document) != 0)) + 1
            head, tail = np.concatenate([[0], apart]), np.concatenate([apart, [len(at)]]) - 1
            period, document = period[head], document[head]
            start = _extended(ids, at[head], bounds[document - 1], period, -1)
            end = _extended(ids, at[tail] + period + size, bounds[document], period, 1)
            found.append((start, end, period))
        hashes = mix(hashes[: max(0, len(hashes) - size)] * np.uint64(ODD) + hashes[size:])
        size *= 2
    if not found:
        return nothing
    start, end, period = (np.concatenate(parts) for parts in zip(*found, strict=True))
    whole = end - start >= np.maximum(min_length, min_exponent * period)
    # Catches rest on hashes of blocks, runs on the words themselves.
    for i in np.flatnonzero(whole):
        s, e, q = start[i], end[i], period[i]
        whole[i] = np.array_equal(ids[s : e - q], ids[s + q : e])
    start, end, period = start[whole], end[whole], period[whole]
    order = np.lexsort([period, start])
    return start[order], end[order], period[order]


def _of_batch(texts: list[bytes], min_length: int, min_exponent: int) -> tuple[list[list[dict]], list[bytes]]:
    known: dict[bytes, int] = defaultdict(count().__next__)
    words = [text.split() for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    ids = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, bounds[-1])
    start, end, period = find_runs(ids, bounds, min_length, min_exponent)
    runs: list[list[dict]] = [[] for _ in texts]
    dropped: dict[int, np.ndarray] = {}
    for row, s, e, q in zip(np.searchsorted(bounds, start, "right") - 1, start, end, period, strict=True):
        s, e = s - bounds[row], e - bounds[row]
        runs[row].append({"start": int(s), "length": int(e - s), "period": int(q)})
        dropped.setdefault(row, np.zeros(len(words[row]), bool))[s + q : e] = True
    for row, gone in dropped.items():
        words[row] = [words[row][i] for i in np.flatnonzero(~gone)]
    return runs, [b" ".join(w) for w in words]


def periodic_runs(
    docs: DataFrame,
    text_column: str = "text",
    keep: list[str] | None = None,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``docs`` with all runs of each text and the text without what its runs repeat.

    Words are stretches of other bytes than ASCII white space, numbered from 0. ``runs`` are ordered by start, then period; a run is a
    maximal stretch of words with smallest period q and at least ``min_length`` and ``min_exponent * q`` words.
    ``collapsed`` joins by one space the words that no run holds after its first q words. Null and empty texts have no
    runs and an empty ``collapsed``. Rows stand for themselves, so repeated rows and ties have equal results, and an empty table gives none.
    A very long text is one row of work: about 100 bytes of memory a word. Columns named like the added ones are replaced.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = [t or b"" for t in column(batch, text_column).cast(pa.large_binary()).to_pylist()]
        runs, collapsed = _of_batch(texts, min_length, min_exponent)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return {"runs": pa.array(runs, kind), "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}

    kept = [c for c in (docs.columns if keep is None else keep)]
    rows = docs.select(*kept, *([] if text_column in kept else [text_column]))
    return append(rows, FOUND, add, keep=kept, by=text_column)


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the run of most periods (exactly; ties: smallest start, then period) and digests in place of texts."""
    most = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.withColumn("__most", most)
    return found.withColumns({
        "n_runs": F.size("runs").cast("long"),
        "start": F.col("__most.start"),
        "length": F.col("__most.length"),
        "period": F.col("__most.period"),
        "exponent_milli": F.expr("(1000 * __most.length) div __most.period"),
        "runs_sha256": F.sha2(lines.cast("binary"), 256),
        "collapsed_sha256": F.sha2(F.col("collapsed").cast("binary"), 256),
    }).drop("__most", "runs", "collapsed")
