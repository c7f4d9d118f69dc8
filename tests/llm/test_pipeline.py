import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from onlinecast.llm import bpe
from onlinecast.llm.queries import RANKS
from tests.llm import test_jaccard, test_repeats
from tests.llm.frames import SMALL, clashing, documents, none_of, odd_docs


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and what comes out last."""
    root = tmp_path_factory.mktemp("stages")
    docs, held = documents(spark), [documents(spark)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        held.append(docs)
    return held


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "decontamination", "tokens"]
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns
        assert 0 < docs.count() <= stages[0].count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == sorted(i for i, (_, c) in test_jaccard.brute(rows).items() if i == c)


def test_repeats_are_cut_out(stages):
    rows = stages[2].orderBy("doc_id").collect()
    want = {}
    for row, ranges in zip(rows, test_repeats.brute([r.text for r in rows])):
        data = bytearray((row.text or "").encode())
        for a, b in reversed(ranges):
            del data[a:b]
        left = bytes(data).decode("utf-8", "ignore")
        if not ranges or left.strip():
            want[row.doc_id] = row.text if not ranges else left
    got = {r.doc_id: r for r in stages[3].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_no_verbatim_passage_is_left(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {r.doc_id for r in stages[3].collect() if any(i in (r.text or "") for i in items)}
    assert not held & set(ids(stages[4]))
    assert len(ids(stages[3])) - len(ids(stages[4])) <= len(held) + 2


def test_tokens_are_those_of_the_library(stages):
    coder = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        packed = np.array(coder.encode_ordinary(texts[r.doc_id] or ""), "<u4").tobytes()
        assert bytes(r.ids) == packed and r.n_tokens * 4 == len(packed)
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_run_is_the_stages_in_a_row(spark, stages):
    columns = ["doc_id", "ids_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select(*columns).collect())) == sorted(
        map(tuple, stages[5].select(*columns).collect())
    )


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, name, stage):
    docs = clashing(odd_docs(spark), "score", "spans", "tid", "hits", "class", "component_id", "__x")
    out = stage(spark, docs, SMALL)
    if name != "tokens":
        assert out.columns == docs.columns
        assert {4, 8} <= {r.doc_id for r in out.collect()}
    else:
        assert out.count() == docs.count()
    assert stage(spark, none_of(docs), SMALL).count() == 0
    nothing = docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields])
    assert stage(spark, nothing, SMALL).count() == docs.count()
