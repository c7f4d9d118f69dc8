import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from onlinecast.llm import bpe
from onlinecast.llm.queries import RANKS, op10_bpe
from tests.llm.frames import SMALL, clashing, documents, none_of, odd_docs


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, public.PATTERN)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text("ab 'sTé中\n\x1c 😀1", max_size=60))
def test_ids_are_those_of_the_library(encoder, reference, text):
    assert ids(encoder.encode([text])[0]) == reference.encode_ordinary(text)


def test_long_words_and_texts(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 1000)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 50)
    for text in ("x" * 30_000, "abc " * 2_000 + "   \n end", "aaaa" * 700):
        assert ids(encoder.encode([text])[0]) == reference.encode_ordinary(text)


def test_forgetting_words_changes_nothing(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(ranks, public.PATTERN)
    for text in ("many different little words", "other ones again", "many words"):
        assert ids(encoder.encode([text])[0]) == reference.encode_ordinary(text)


def test_merges_apply_leftmost_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aaab": 258}
    assert [ids(x) for x in bpe.Replayer(ranks).encode([b"aaa", b"aab", b"aaaab", b"q", b"aaab"])] == [
        [256, 97], [256, 98], [256, 256, 98], [113], [258],
    ]


def test_query_against_the_library(spark, reference):
    got = {r.doc_id: r for r in op10_bpe(spark, SMALL).collect()}
    rows = documents(spark).collect()
    assert len(rows) == len(got)
    for row in rows:
        want = reference.encode_ordinary(row.text or "")
        assert got[row.doc_id].n_tokens == len(want)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_odd_rows_and_round_trip(spark, reference):
    docs = clashing(odd_docs(spark), "ids", "n_tokens", "decoded")
    rows = bpe.decode(bpe.encode(docs, RANKS, public.PATTERN), RANKS).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert bytes(row.decoded).decode() == (row.text or "")
        assert row.n_tokens == len(reference.encode_ordinary(row.text or "")) == len(row.ids) // 4
    assert bpe.digests(none_of(docs), RANKS, public.PATTERN).count() == 0
    pattern = regex.compile(public.PATTERN)
    assert "".join(pattern.findall(rows[0].text or "")) == (rows[0].text or "")
