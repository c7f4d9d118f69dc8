"""Dialogues rendered once from the view of every participant.

For each participant of a conversation the whole dialogue is rendered with that speaker as the assistant and
the others as named users; the mask tells which characters the assistant said. A long dialogue comes in parts of a
bounded number of messages, so no conversation has to fit into one row or task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import append, column
from onlinecast.plans.ordering import with_position

PART_MESSAGES = 64
SYSTEM = "system"
NAMELESS = "unknown"


def rendered(said: list[dict], perspective: str) -> tuple[str, list[dict], int]:
    """Text of messages in order, the ranges of characters the perspective's speaker said, and how many those are."""
    pieces, mask, at, trained = [], [], 0, 0
    for message in sorted(said, key=lambda m: m["pos"]):
        speaker, content = message["speaker"], message["content"]
        own = speaker == perspective
        head = "<|assistant|>\n" if own else "<|system|>\n" if speaker == SYSTEM else f"<|user|>{speaker}\n"
        if own:
            mask.append({"start": at + len(head), "end": at + len(head) + len(content)})
            trained += len(content)
        piece = f"{head}{content}<|end|>\n"
        pieces.append(piece)
        at += len(piece)
    return "".join(pieces), mask, trained


def perspectives(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    part_messages: int = PART_MESSAGES,
) -> DataFrame:
    """A row for each conversation, participant (``perspective``) and ``part`` of at most ``part_messages`` messages.

    Has ``n_messages``, the ``text``, the ``mask`` (start and end of each stretch the participant said, in code
    points of the text) and ``n_trained``, the code points under the mask. Everyone who speaks is a participant,
    but for the system, whose messages stay what they are. Messages follow their turn, then role and text, nulls
    first; repeated messages are all kept. A null role speaks as ``unknown``, a null text is an empty message with
    an empty stretch. Messages without conversation are left out, and a conversation of system messages
    alone has no perspective. Other columns are ignored.
    """
    rows = messages.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(NAMELESS)).alias("speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"),
    )
    placed = with_position(rows, ["conversation"], ["turn", "speaker", "content"], "pos").drop("turn")
    views = rows.where(F.col("speaker") != SYSTEM).select("conversation", F.col("speaker").alias("perspective")).distinct()
    seen = placed.withColumn("part", F.floor(F.col("pos") / part_messages).cast("int")).join(views, "conversation")
    parts = seen.groupBy("conversation", "perspective", "part").agg(
        F.collect_list(F.struct("pos", "speaker", "content")).alias("said")
    )

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        views = column(batch, "perspective").to_pylist()
        done = [rendered(said.as_py(), view) for said, view in zip(column(batch, "said"), views, strict=True)]
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {
            "n_messages": pa.array([len(said) for said in column(batch, "said")], pa.int64()),
            "text": pa.array([d[0] for d in done], pa.string()),
            "mask": pa.array([d[1] for d in done], spans),
            "n_trained": pa.array([d[2] for d in done], pa.int64()),
        }

    fields = "n_messages long, text string, mask array<struct<start:bigint,end:bigint>>, n_trained long"
    out = append(parts, fields, add, ["conversation", "perspective", "part"])
    return out.withColumnRenamed("conversation", conversation)
