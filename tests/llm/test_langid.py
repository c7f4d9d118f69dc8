import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from onlinecast.llm import langid
from onlinecast.llm.queries import op2_language
from tests.llm.frames import clashing, none_of, odd_docs


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 20):
        code = langid.codewords(n)
        apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2)
        assert len(code) == n
    assert langid.codewords(1).shape == (1, 1)
    assert min(int((c != d).sum()) for k, c in enumerate(langid.codewords(4)) for d in langid.codewords(4)[:k]) == 4


def test_some_wrong_bits_do_not_change_the_answer():
    model = langid.CodedClassifier(list("abcd"))
    model.weights, model.bias = np.eye(7), np.zeros(7)
    model.trust = np.full(7, 1 / 7)
    for k, word in enumerate(model.code):
        for bit in range(7):
            seen = 3.0 * word
            seen[bit] = -seen[bit]
            assert model.decode(seen[None])[0][0] == k


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op2_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    row = got.where("held_out and lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("lo"), F.max("score").alias("hi")
    ).first()
    assert row.right >= 0.97
    assert 0 <= row.lo <= row.hi <= 1
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    assert got.where((remainder == 2) != F.col("held_out")).count() == 0


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "score", "lang_pred")
    rows = langid.predict(docs, langid.fit(docs)).collect()
    assert len(rows) == docs.count()
    for row in rows:
        letters = row.text is not None and any(c.isalpha() for c in row.text)
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1 and (letters or (row.score == 0 and row.ambiguous))
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text, row.lang_pred) == row.lang_pred


def test_without_labels_or_rows(spark):
    docs = odd_docs(spark)
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    empty = none_of(docs)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    one = langid.fit(docs.withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in langid.predict(docs, one).collect()} == {"xx", "und"}


def test_a_long_text_counts_as_a_whole():
    text = "the quick brown fox " * 120_000
    whole = next(langid.features_of(pa.array([text])))[0]
    part = next(langid.features_of(pa.array([text[:2_000]])))[0]
    assert np.abs(whole - part).max() < 0.02
