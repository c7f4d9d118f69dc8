"""Exact dedup against plain grouping, also with a filter that is too small."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from onlinecast.llm import exact
from onlinecast.llm.common import Scratch
from tests.llm.frames import DOCS, LONG, clashing, documents, none_of, odd_docs


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[normal(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(normal(r.text).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(docs):
    return sorted(map(tuple, exact.duplicates(docs).collect()), key=repr)


def test_odd_rows(spark):
    docs = odd_docs(spark).unionByName(
        spark.createDataFrame([(20, "ÄRA Z", None, None, None), (21, "Ära z", None, None, None), (22, "ära z", None, None, None),
                               (23, "ÄRA z", None, None, None), (None, None, None, None, None)], DOCS)
    )
    docs = clashing(docs, "keep_id", "kept", "group_size", "text_sha256")
    assert result(docs) == brute(docs.collect())
    assert exact.duplicates(docs).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert result(none_of(docs)) == []


@pytest.mark.parametrize("limit", [1, 64, 1 << 21])
def test_any_size_of_the_filter(spark, monkeypatch, limit):
    """A folded filter lets more rows shuffle and changes nothing."""
    monkeypatch.setattr(exact, "MAX_WORDS", limit)
    docs = documents(spark)
    assert result(docs) == brute(docs.collect())


def test_only_rows_that_may_be_repeated_are_looked_up(spark):
    texts = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.least("id", F.lit(39_000))).alias("text"))
    scratch = Scratch(spark, "test")
    keys = exact._keys(texts, "doc_id", "text", scratch)
    twice, words = exact.set_twice(keys, scratch)
    maybe, alone = exact._split(keys, twice, words)
    assert maybe.count() + alone.count() == 40_000
    assert maybe.where("__id >= 39000").count() == 1000
    assert maybe.count() < 1200
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


def test_hot_text(spark):
    """A third of all rows share a text."""
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(LONG[:500])).otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    found = exact.duplicates(docs)
    assert found.where("group_size = 10000 and keep_id = 29997").count() == 10_000
    assert found.where("kept").count() == 20_001


def test_whole_rows(spark):
    docs = clashing(odd_docs(spark), "kept", "keep_id")
    left = exact.deduplicated(docs)
    assert left.schema == docs.schema
    rows = left.collect()
    want = {normal(r.text): k for r in docs.collect() for k in [r.doc_id]}
    assert sorted(normal(r.text) for r in rows) == sorted(want)
    assert {r.doc_id for r in rows} == {2, 3, 4, 5, 6, 7, 8, 9}
    assert exact.deduplicated(none_of(docs)).count() == 0
