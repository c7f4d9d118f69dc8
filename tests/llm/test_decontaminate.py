import random
import tracemalloc

import numpy as np

from onlinecast.llm import decontaminate as dec
from onlinecast.llm.common import Roller
from onlinecast.llm.queries import op5_decontaminate
from tests.llm.frames import SMALL, clashing, documents, none_of, odd_docs

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def normal(text):
    return dec.plain(*_bytes(text), 0)[0].tobytes()


def _bytes(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return data, np.array([0, len(data)])


def occurs(window, text, edits):
    """Whether the window occurs in the text with at most so many edits."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row) <= edits


def brute(docs, items):
    found = set()
    for item, passage in items:
        index = dec.Passages([passage])
        for s in index.starts[0]:
            window = index.text[s : s + index.window[0]].tobytes()
            for doc, text in docs:
                if (doc, item) not in found and occurs(window, normal(text), int(index.edits[0])):
                    found.add((doc, item))
    return found


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def changed(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        text[at : at + 1] = rng.choice([[], ["q"], [text[at], "z"]])
    return "".join(text)


def test_edited_passages_against_brute_force(spark):
    rng = random.Random(2)
    items = [(k, words(rng, rng.choice([4, 12, 25, 40]))) for k in range(8)]
    docs = []
    for k in range(24):
        item = rng.choice(items)[1]
        part = item[rng.randrange(max(1, len(item) - 90)) :]
        docs.append((k, f"{words(rng, 20)} {changed(rng, part, rng.randrange(0, 14))} {words(rng, 15)}"))
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id) for r in dec.contamination(*frames).collect()}
    want = brute(docs, items)
    assert got == want
    assert 5 < len(want) < 60


def test_case_and_spaces_do_not_matter(spark):
    passage = "Élan vital: the quick brown fox jumps over the lazy dog, again and again, until the evening comes at last."
    docs = [(1, "x " + passage.upper() + " y"), (2, passage.replace(" ", " \n ")), (3, passage.replace(",", "  -- ")), (4, passage[:40])]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(5, passage)], ITEMS)
    got = {r.doc_id: r for r in dec.contamination(*frames).collect()}
    assert set(got) == {1, 2, 3}
    text = docs[0][1].encode()
    assert text[got[1].start : got[1].end].decode().strip(" .") == passage.upper().strip(" .")


def test_query_finds_every_verbatim_passage(spark):
    got = {(r.doc_id, r.item_id) for r in op5_decontaminate(spark, SMALL).collect()}
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    docs = documents(spark).collect()
    verbatim = {(d.doc_id, i.item_id) for d in docs for i in items if d.text and i.text in d.text}
    assert verbatim <= got
    assert all(any(normal(i.text)[:30] in normal(d.text) for i in items) for d in docs if d.doc_id in {g[0] for g in got})


def test_long_texts_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(dec, "PIECE", 5_000)
    monkeypatch.setattr(dec, "ITEM_BYTES", 300)
    rng = random.Random(4)
    items = [(k, words(rng, 30)) for k in range(6)]
    text = words(rng, 700) + " " + items[3][1] + " " + words(rng, 800) + " " + items[1][1]
    docs = spark.createDataFrame([(1, text), (2, words(rng, 50))], DOCS)
    rows = dec.contamination(docs, spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in rows) == [(1, 1, 0), (1, 3, 0)]
    for r in rows:
        assert text[r.start : r.end].strip() == items[r.item_id][1]


def test_wide_runs_at_the_border_of_pieces(spark, monkeypatch):
    """A passage laid out with runs of spaces is found wherever a long text is cut."""
    rng = random.Random(8)
    passage = words(rng, 14)
    wide = passage.replace(" ", " " + "." * 60 + "\n ")
    docs = [(k, words(rng, 500)[: 2_000 - 97 * k] + " " + wide + " " + words(rng, 300)) for k in range(10)]
    docs.append((10, "É" * 999 + " " + wide + " " * 9_000 + words(rng, 40)))
    docs = spark.createDataFrame(docs, DOCS)
    items = spark.createDataFrame([(1, passage)], ITEMS)
    whole = sorted(dec.contamination(docs, items).collect())
    assert [r.doc_id for r in whole] == list(range(11))
    monkeypatch.setattr(dec, "PIECE", 2_000)
    assert sorted(dec.contamination(docs, items).collect()) == whole


def test_passages_never_cross_documents():
    passage = words(random.Random(1), 30)
    index = dec.Passages([passage])
    half = len(passage) // 2
    data = np.frombuffer((passage[:half] + passage[half:]).encode(), np.uint8)
    assert index.hits(data, np.array([0, len(data)]), Roller())
    short = dec.Passages([passage[half - 40 : half + 40]])
    assert not short.hits(data, np.array([0, half, len(data)]), Roller())


def test_odd_rows(spark):
    passage = "one passage that is long enough to be searched for, with some more words to make it so, and a few more"
    docs = clashing(odd_docs(spark), "hits", "item_id", "start", "edits")
    more = docs.where("doc_id = 5").selectExpr(*[f"'{passage}' AS text" if c == "text" else c for c in docs.columns])
    docs = docs.union(more).union(more)
    items = spark.createDataFrame([(1, passage), (1, passage), (2, passage), (3, None), (4, ""), (5, "tiny"), (None, passage)], ITEMS)
    rows = dec.contamination(docs, items).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in rows) == [(5, 0)] * 2 + [(5, 1)] * 2 + [(5, 2)] * 2
    left = dec.without_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 2
    assert dec.without_contaminated(docs, none_of(items)).count() == docs.count()
    assert dec.contamination(none_of(docs), items).count() == 0


def test_slices_find_what_whole_texts_do(monkeypatch):
    rng = random.Random(11)
    items = [words(rng, 60), "ab " * 90, "z" * 300, words(rng, 25)]
    texts = [words(rng, 200), words(rng, 150) + " " + changed(rng, items[0], 3) + " " + words(rng, 150)]
    texts += ["ab " * 700 + changed(rng, items[3], 1), "z" * 2500 + " " + items[0][:120] + "z" * 90, ""]
    values = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(values), np.uint8)
    offsets = np.cumsum([0, *map(len, values)])
    index, found = dec.Passages(items), []
    for matches in (1 << 21, 60_000, 1):
        monkeypatch.setattr(dec, "MATCHES", matches)
        rows = {}
        for row, *hit in index.hits(data, offsets, Roller()):
            rows.setdefault(row, []).append(tuple(hit))
        found.append({row: dec.merged(hits) for row, hits in rows.items()})
    assert {(row, h["item"]) for row, hits in found[0].items() for h in hits} >= {(1, 0), (2, 1), (2, 3), (3, 2), (3, 0)}
    assert found[0] == found[1] == found[2]


def test_texts_of_one_letter_stay_small():
    data = np.full(1_000_000, ord("a"), np.uint8)
    index = dec.Passages(["a" * 5_000])
    tracemalloc.start()
    hits = dec.merged([h[1:] for h in index.hits(data, np.array([0, len(data)]), Roller())])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == [{"item": 0, "start": 0, "end": 1_000_000, "edits": 0}]
    assert peak < 1 << 30
