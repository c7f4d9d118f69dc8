from onlinecast.llm import chat
from tests.llm.frames import clashing, none_of

TALK = "conv_id long, turn long, role string, text string"


def test_every_participant_once(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "Ann", "hi"), (1, 2, "Bob", "hé"), (1, 3, "Ann", "bye"), (2, 0, "system", "alone")]
    got = {(r.conv_id, r.perspective): r for r in chat.perspectives(spark.createDataFrame(rows, TALK)).collect()}
    assert set(got) == {(1, "Ann"), (1, "Bob")}
    ann = got[1, "Ann"]
    assert ann.text == (
        "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user|>Bob\nhé<|end|>\n<|assistant|>\nbye<|end|>\n"
    )
    assert [ann.text[m.start : m.end] for m in ann.mask] == ["hi", "bye"]
    bob = got[1, "Bob"]
    assert [bob.text[m.start : m.end] for m in bob.mask] == ["hé"] and bob.n_trained == 2 and bob.n_messages == 4


def test_long_dialogues_come_in_parts(spark):
    rows = [(7, k, "ab"[k % 2], f"m{k}") for k in range(150)]
    got = chat.perspectives(spark.createDataFrame(rows, TALK).repartition(5), part_messages=64).collect()
    for view in "ab":
        parts = sorted((r for r in got if r.perspective == view), key=lambda r: r.part)
        assert [r.n_messages for r in parts] == [64, 64, 22]
        said = [r.text[m.start : m.end] for r in parts for m in r.mask]
        assert said == [f"m{k}" for k in range(150) if "ab"[k % 2] == view]


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 1, "a", ""), (1, 1, "a", ""), (1, 1, "b", "x" * 200_000), (None, 0, "a", "nowhere"),
        (3, 0, "a", "only me"), (4, 5, "a", None),
    ]
    talk = clashing(spark.createDataFrame(rows, TALK), "pos", "part", "mask", "perspective", "conversation")
    got = {(r.conv_id, r.perspective): r for r in chat.perspectives(talk).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (1, "unknown"), (3, "a"), (4, "a")}
    assert got[1, "a"].n_messages == 4 and [m.end - m.start for m in got[1, "a"].mask] == [0, 0]
    assert got[1, "b"].n_trained == 200_000
    assert got[1, "unknown"].text.startswith("<|assistant|>\n<|end|>\n<|user|>a\n<|end|>\n")
    assert got[4, "a"].n_trained == 0 and len(got[4, "a"].mask) == 1
    assert chat.perspectives(none_of(talk)).count() == 0
