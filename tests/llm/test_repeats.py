import random
from collections import Counter
from hashlib import sha256

import pytest

from onlinecast.llm import repeats
from onlinecast.llm.queries import op7_repeats
from tests.llm.frames import SMALL, clashing, documents, none_of, odd_docs


def brute(texts, length=200):
    """Byte ranges to remove of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        ranges = []
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                if ranges and k <= ranges[-1][1]:
                    ranges[-1][1] = k + length
                else:
                    ranges.append([k, k + length])
        out.append(ranges)
    return out


def check(spark, texts, parts=3):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts, "doc_id")
    got = {r.doc_id: [[s.start, s.end] for s in r.spans or []] for r in repeats.with_repeats(docs).collect()}
    want = brute(texts)
    assert {i: want[i] for i in got} == got


def test_query_against_brute_force(spark):
    rows = documents(spark).collect()
    want = brute([r.text for r in rows])
    got = {r.doc_id: r for r in op7_repeats(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for row, ranges in zip(rows, want):
        data = (row.text or "").encode()
        kept = bytearray(data)
        for a, b in reversed(ranges):
            del kept[a:b]
        r = got[row.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), len(data) - len(kept), len(ranges))
        assert r.kept_sha256 == sha256(bytes(kept)).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_planted_repeats(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(35, 120)) for _ in range(6)]
    texts = []
    for _ in range(30):
        pieces = [text(rng.randint(0, 60)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randrange(0, max(1, len(piece) - 195))
            piece = piece[cut : cut + rng.choice([190, 199, 200, 201, 260, 999])]
            if rng.random() < 0.4:
                at = rng.randrange(len(piece))
                piece = piece[:at] + "#" + piece[at + 1 :]
            pieces.insert(rng.randrange(len(pieces)), piece)
        texts.append(" ".join(pieces))
    check(spark, texts)


def test_periods_and_copies(spark):
    long = "".join(chr(97 + (k * k) % 23) for k in range(700))
    texts = ["ab" * 300, "a" * 199, "a" * 200, "a" * 201, "a" * 450, long, long, long[:200], long[1:200], None, "", "ba" * 150]
    check(spark, texts)


def test_a_long_text_in_parts(spark, monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(9_000))
    texts = [base + base[3_000:3_400], "zz" + base[100:5_000], base[8_000:]]
    monkeypatch.setattr(repeats, "BLOCK", 1_500)
    check(spark, texts)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "spans", "tid", "runs", "first")
    rows = repeats.with_repeats(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert [tuple(s) for s in r.spans or []] == ([(0, len(r.text))] if r.doc_id == 7 else [])
    left = repeats.without_repeats(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    assert repeats.removal_digests(none_of(docs)).count() == 0
    assert repeats.without_repeats(none_of(docs)).count() == 0


def test_cut_characters_and_counts(spark):
    passage = "é" * 60 + "x".join(str(k) for k in range(60))
    docs = spark.createDataFrame(
        [(1, "ü start " + passage + " end", 5), (2, passage, 5), (3, "left alone", 5)], "doc_id long, text string, n_chars long"
    )
    got = {r.doc_id: r for r in repeats.without_repeats(docs).collect()}
    assert set(got) == {1, 3}
    assert got[1].text == "ü start  end" and got[1].n_chars == 12
    assert got[3].text == "left alone"
