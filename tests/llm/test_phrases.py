"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from onlinecast.llm import phrases
from tests.llm.frames import DOCS, LONG, clashing, documents, none_of, odd_docs


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counted(rows):
    f, n = Counter(), Counter()
    for r in rows:
        lang = r.lang if r.lang is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(r.text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    return f, n


def brute(rows, least, first):
    f, n = counted(rows)
    frequent = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    dropped = set()
    for (lang, words), a in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, words[i : i + size])
                if 100 * a >= 100 * f[part]:
                    dropped.add(part)
    found = {}
    for (lang, words), a in frequent.items():
        if (lang, words) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            row = (" ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score)
            found.setdefault(lang, []).append(row)
    out = []
    for lang, rows in found.items():
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:first])]
    return sorted(out)


def result(docs, **settings):
    return sorted(map(tuple, phrases.collocations(docs, **settings).collect()))


@pytest.mark.parametrize("hot", [1 << 20, 5])
def test_documents(spark, monkeypatch, hot):
    """Also where routes go by four words, and buckets and slices are small."""
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "BUCKET_PLACES", 1000)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 100_000)
    docs = documents(spark)
    want = brute(docs.collect(), 12, 50)
    assert len(want) > 50
    assert result(docs, least=12, first=50) == want


def test_odd_rows(spark):
    rows = [(30 + i, "A b\tc D, e f g!\n\nQ   r s t u v w\x0b x y z \x00   é È", lang, None, None) for i, lang in enumerate(["en", None, "und", "fr"] * 3)]
    rows += [(50, "a " * 40, "en", None, None), (51, "aa bb, " * 10, "en", None, None)]
    docs = odd_docs(spark).where("doc_id <> 7 or doc_id is null").unionByName(spark.createDataFrame(rows, DOCS))
    docs = clashing(docs, "n", "a", "phrase", "rank", "score", "word", "bucket")
    want = brute(docs.collect(), 3, 1000)
    assert {"en", "und", "fr"} == {r[0] for r in want}
    assert result(docs, least=3, first=1000) == want
    assert result(none_of(docs), least=3) == []
    assert result(docs.where("text is null or text = ''"), least=1) == []


def test_long_text(spark):
    docs = spark.createDataFrame([(1, LONG, "en", None, None)] * 2, DOCS)
    assert result(docs, least=40, first=300) == brute(docs.collect(), 40, 300)


def test_large_numbers_stay_exact(spark):
    """Products beyond 64 bits."""
    a, n, l, r = 7_000_000_000_011, 90_000_000_000_007, 8_000_000_000_017, 7_500_000_000_003
    got = spark.sql(
        f"SELECT (cast({a}L * 1000 as decimal(19,0)) * cast({n}L as decimal(19,0))) div (cast({l}L as decimal(19,0)) * cast({r}L as decimal(19,0))) s"
    ).first().s
    assert got == 1000 * a * n // (l * r)


def test_sort_counts_prefixes():
    rng = random.Random(3)
    rows = [[rng.randrange(2)] + [int(rng.paretovariate(0.7)) % 9 for _ in range(5)] for _ in range(4000)]
    codes = np.array(rows)
    for i, row in enumerate(codes):
        row[3 + i % 4 :] = -1
    weights = np.array([rng.randrange(1, 4) for _ in rows])
    want = Counter()
    for row, w in zip(codes.tolist(), weights.tolist()):
        words = [c for c in row if c >= 0]
        for depth in range(2, len(words)):
            want[tuple(words[: depth + 1])] += w
    for complete, least in ((2, 25), (4, 25), (2, 1)):
        found = phrases.sorted_counts(codes, weights, np.full(len(codes), complete), least)
        got = {tuple(codes[i, : d + 1].tolist()): n for i, d, n in found}
        assert got == {k: n for k, n in want.items() if n >= least or len(k) - 1 < complete}
