"""Periodic runs against their definition."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from onlinecast.llm.queries import op12_runs, with_periods
from onlinecast.llm.runs import find_runs, periodic_runs, run_digests
from tests.llm.frames import DOCS, LONG, SMALL, clashing, documents, none_of, odd_docs


def period_of(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q) and period_of(words[start : start + length]) == q:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    kind = rng.randrange(4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(60))]
    if kind == 1:
        return [rng.choice("abcd") for _ in range(rng.randrange(90))]
    words = []
    while len(words) < 120:
        unit = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
        words += unit * rng.randrange(1, 8) + unit[: rng.randrange(len(unit) + 1)]
        words += [rng.choice("abcdef") for _ in range(rng.randrange(3 * kind))]
    return words


def test_runs_of_many_sequences_at_once():
    rng = random.Random(5)
    sequences = [random_words(rng) for _ in range(1500)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
    ids = np.array([ord(w) for s in sequences for w in s], np.int64)
    start, end, period = find_runs(ids, bounds)
    row = np.searchsorted(bounds, start, "right") - 1
    got = [[] for _ in sequences]
    for r, s, e, q in zip(row, start, end, period, strict=True):
        got[r].append((s - bounds[r], e - s, q))
    assert got == [brute(s) for s in sequences]
    assert sum(map(len, got)) > 1000


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33, 64, 100])
@pytest.mark.parametrize("before", [0, 1, 2, 5, 13])
def test_shortest_runs(period, before):
    """Runs of exactly the least length at any place are caught, shorter ones are not."""
    least = max(6, 4 * period)
    for length, runs in ((least, 1), (least - 1, 0)):
        ids = np.array([-1 - i for i in range(before)] + [i % period for i in range(length)] + [-99], np.int64)
        start, end, found = find_runs(ids, np.array([0, len(ids)]))
        assert [tuple(x) for x in zip(start, end, found)] == [(before, before + length, period)] * runs


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), np.array([0, 9]), min_exponent=2)


def test_query(spark):
    def planted(key, words):
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 or not n:
            return words
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]

    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    got = {r.doc_id: r for r in op12_runs(spark, SMALL).collect()}
    assert set(got) == set(texts)
    with_runs = 0
    for key, text in texts.items():
        words = planted(key, [w.decode() for w in (text or "").encode().split()])
        if len(words) > 3000:
            continue
        runs = brute(words)
        row, with_runs = got[key], with_runs + bool(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == best
        assert row.n_runs == len(runs)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs > 5


def test_only_every_tenth_text_gets_a_tail(spark):
    docs = odd_docs(spark).select("doc_id", "text", F.col("text").alias("before"))
    rows = with_periods(docs).collect()
    assert len(rows) == 11
    for row in rows:
        chosen = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 10 == 0
        assert chosen or row.text == row.before


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "runs", "collapsed", "n_runs", "start")
    found = periodic_runs(docs)
    assert found.columns == [c for c in docs.columns if c not in ("runs", "collapsed")] + ["runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == 11
    for row in rows:
        words = (row.text or "").split()
        assert [tuple(r) for r in row.runs] == (brute(words) if len(words) < 1000 else [])
        assert row.collapsed == " ".join(words) or row.runs
    assert run_digests(found).count() == 11
    assert periodic_runs(none_of(odd_docs(spark))).count() == 0


def test_long_periodic_text(spark):
    """One text of 600,000 words, the second half of which repeats 5,000 words."""
    words = LONG.split()
    words = words + [f"x{i}" for i in range(240_000)] + [f"y{i % 5000}" for i in range(300_000)] + ["end"]
    row = periodic_runs(spark.createDataFrame([(1, " ".join(words), None, None, None)], DOCS)).first()
    at = len(words) - 300_001
    assert [tuple(r) for r in row.runs] == [(at, 300_000, 5000)]
    assert row.collapsed == " ".join(words[: at + 5000] + ["end"])
