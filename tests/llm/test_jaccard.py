import random
import re

import numpy as np
import pytest

from onlinecast.llm import components as comp
from onlinecast.llm import jaccard
from onlinecast.llm.queries import op6_jaccard
from tests.llm.frames import SMALL, clashing, documents, none_of, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """n_shingles and component of each (id, text), ids unique."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(docs).collect()}
    assert got == brute(rows)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op6_jaccard(spark, SMALL).collect()} == brute(rows)


@pytest.mark.parametrize("seed", [0, 1])
def test_chains_and_large_groups(spark, seed):
    rng = random.Random(seed)
    rows, at = [], 0
    common = [f"c{k}" for k in range(12)]
    for group in range(14):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice([6, 20, 60]))]
        for _ in range(rng.choice([1, 2, 9])):
            # a chain: each is a small change of the one before, the ends are far apart
            for _ in range(rng.choice([0, 1, 2])):
                base = base[:]
                base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
            words = common + base if rng.random() < 0.5 else base
            rows.append((at * 7 % 997, " ".join(words)))
            at += 1
    check(spark, rows)


def test_hot_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "OFTEN_LEAST", 3)
    monkeypatch.setattr(jaccard, "HOT_LEAST", 4)
    seen = []
    find = jaccard.hot_shingles
    monkeypatch.setattr(jaccard, "hot_shingles", lambda rows: seen.append(find(rows)) or seen[-1])
    test_chains_and_large_groups(spark, 0)
    assert len(seen[0]) > 5


def test_overlaps_sum_over_fragments(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 3)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, rng.integers(0, 25))) for _ in range(12)]
    owner = np.repeat(np.arange(12), [len(s) for s in sets])
    left, right = np.arange(0, 7), np.arange(7, 12)
    for a, b in ((left, right), (np.arange(12), np.arange(12))):
        got = jaccard.overlaps(owner, np.concatenate(sets), a, b)
        want = np.array([[len(np.intersect1d(sets[i], sets[j])) for j in b] for i in a])
        others = a[:, None] != b[None, :]
        assert (got[others] == want[others]).all()


def test_groups_of_many_blocks(spark, monkeypatch):
    """One passage in many unlike texts, and a group of near copies: blocks smaller than both."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 200)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(30)]
    rows = [(k, " ".join(passage + [f"u{k}v{j}" for j in range(rng.choice([2, 6, 12]))])) for k in range(30)]
    for k in range(30, 55):
        words = passage[:]
        words[rng.randrange(30)] = f"y{k % 9}"
        rows.append((k, " ".join(words)))
    check(spark, rows)


def test_threshold_is_exact(spark):
    # 3 of 4 shingles of the union shared, and one less
    a = "a b c d e f g h"
    rows = [(1, a), (2, a.rsplit(" ", 1)[0]), (3, "p q r s t u v"), (4, "p q r s t u"), (5, "p q r s t")]
    check(spark, rows)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "class", "component_id", "n_shingles", "token")
    rows = jaccard.linked(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)}
    assert by[5] == {(1, 5)} and by[6] == {(1, 5)}
    assert by[7] == {(len(shingles(docs.where("doc_id = 7").first().text)), 7)}
    assert by[None] == {(1, 9)} and by[9] == {(1, 9)}
    left = jaccard.representatives(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 7, 8, 9]
    assert jaccard.linked(none_of(docs)).count() == 0
    assert jaccard.representatives(none_of(docs)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (7, 6)]
    rng = random.Random(3)
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    got = {r.node: r.component for r in comp.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert comp.components(spark.createDataFrame([], "u long, v long")).count() == 0
