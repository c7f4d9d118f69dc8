import numpy as np
from pyspark.sql import functions as F

from onlinecast.llm import toxicity
from onlinecast.llm.queries import op8_toxicity
from tests.llm.frames import clashing, none_of, odd_docs

LABELS = "doc_id long, quality int, toxic int"


def sets(rows):
    return np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.concatenate([np.array(sorted(r)) for r in rows])


def test_pairs_that_single_weights_miss():
    """Toxic is either of two terms, but not both and not none: no additive weights can tell."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        row = {int(t) for t in rng.integers(10, 40, 3)} | ({1} if a else {2}) | ({3} if b else {4})
        rows.append(row)
        labels.append(float(a != b))
    indptr, features = sets(rows)
    labels = np.array(labels)
    machine = toxicity.FactorizationMachine().fit(
        indptr, features, labels, np.ones(len(rows)), epochs=40, rate=0.3, sparsity=1e-5
    )
    where = np.repeat(np.arange(len(rows)), np.diff(indptr))
    right = ((machine.margins(len(rows), where, features) > 0) == (labels > 0)).mean()
    assert right > 0.95
    machine.vectors[:] = 0
    assert ((machine.margins(len(rows), where, features) > 0) == (labels > 0)).mean() < 0.7


def planted(spark, n=600):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [words[k] for k in rng.integers(0, 300, 60)]
        toxic = i % 4 == 0
        if toxic:
            text[5], text[40] = "Vile", "SCOUNDREL,"
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_rows(spark):
    docs, labels = planted(spark)
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 600
    assert sum(r.predicted == r.toxic for r in got) >= 590
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = planted(spark)
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_query_columns(spark):
    rows = op8_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    assert {r.held_out for r in rows} == {True, False}


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "score", "predicted", "toxic", "quality")
    labels = spark.createDataFrame(
        [(1, 0, 1), (2, 0, 0), (5, 1, 1), (5, 1, 0), (7, None, 0), (None, 0, 1), (8, 0, None), (99, 0, 1)], LABELS
    )
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns


def test_without_labels_or_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity(docs, labels).where("predicted = 1").count() == 0
    assert toxicity.without_toxic(none_of(docs), labels).count() == 0
