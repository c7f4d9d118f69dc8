"""Exact dedup by a Bloom filter in two passes: only rows whose hash may be repeated shuffle.

Pass one counts how often each bit of a wide Bloom filter is set. A bit is a row of a grouped table, so the
filter is spread over all tasks, counts are combined before they shuffle, and a text that a third of the rows
share is a few rows of it. The bits set more than once, packed into words, are the second filter. It is folded
to at most ``MAX_WORDS`` words, whatever the input, and broadcast; pass two looks every row up in it. Rows of which a
bit is missing have a text of their own and pass. The others are grouped by their digest.

A filter that fills up at a very large input lets more rows shuffle; it never changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Scratch
from onlinecast.plans.joins import attach

MAX_WORDS = 1 << 21
SPARSE = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def normal(text: str) -> Column:
    """Text with A-Z lower-cased and nothing else; a null is an empty text."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)


def _bits() -> list[Column]:
    """The two different bits, 0 to 63, that a row sets in its word."""
    first = F.shiftrightunsigned("__hash", 58)
    step = F.pmod(F.shiftrightunsigned("__hash", 49), F.lit(63)) + 1
    return [first.cast("int"), F.pmod(first + step, F.lit(64)).cast("int")]


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__hash", F.xxhash64("text_sha256"))


def set_twice(keys: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """Bits of the filter that more than one row of ``keys`` (column ``text_sha256``) sets, as (__word, __set), and the number of words."""
    words = 1 << max(6, (SPARSE * max(1, keys.count()) - 1).bit_length())
    place = F.col("__hash").bitwiseAND(F.lit(words - 1))
    each = _hashed(keys).select(place.alias("__word"), F.explode(F.array(*_bits())).alias("__bit"))
    twice = each.groupBy("__word", "__bit").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    packed = twice.groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__set"))
    packed = scratch.write(packed, "twice")
    if packed.count() > MAX_WORDS:
        words = MAX_WORDS
        folded = F.col("__word").bitwiseAND(F.lit(words - 1)).alias("__word")
        packed = scratch.write(packed.groupBy(folded).agg(F.expr("bit_or(__set)").alias("__set")), "folded")
    return packed, words


def _split(rows: DataFrame, twice: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose text may be repeated, and the others."""
    first, second = _bits()
    rows = _hashed(rows).withColumns({"__first": first, "__second": second})
    rows = rows.withColumns({
        "__mask": F.expr("shiftleft(1L, __first) | shiftleft(1L, __second)"),
        "__word": F.col("__hash").bitwiseAND(F.lit(words - 1)),
    })
    found = rows.join(F.broadcast(twice), "__word", "left")
    maybe = F.coalesce(F.col("__set").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    found = found.withColumn("__maybe", maybe).drop("__hash", "__first", "__second", "__mask", "__word", "__set")
    return found.where("__maybe").drop("__maybe"), found.where("not __maybe").drop("__maybe")


def _keys(docs: DataFrame, id_column: str, text_column: str, scratch: Scratch) -> DataFrame:
    digest = F.sha2(normal(text_column).cast("binary"), 256).alias("text_sha256")
    return scratch.write(docs.select(F.col(id_column).alias("__id"), digest), "keys")


def _groups(maybe: DataFrame, scratch: Scratch) -> DataFrame:
    """Texts that really are repeated: the id that stays and the number of rows."""
    sizes = maybe.groupBy("text_sha256").agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__size"))
    return scratch.write(sizes.where("__size > 1"), "groups")


def _finished(rows: DataFrame) -> DataFrame:
    keep = F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep"))
    return rows.withColumns({
        "keep_id": keep,
        "group_size": F.coalesce("__size", F.lit(1)).cast("long"),
        "kept": F.col("__id").eqNullSafe(keep),
    })


def duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row its id, the id that stays of the rows with equal text, their number, and the digest.

    Texts are equal when they are identical after lower-casing A-Z. Of equal texts the largest id stays. A null text
    is an empty one and an empty text is equal to any other; texts of any length are read whole, once. A null id is
    smaller than all others, and stays where all ids of the group are null. Rows repeated with the id
    that stays are all marked kept (``deduplicated`` leaves one). An empty table gives no rows. Other columns are
    not read, so their names do not matter.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    keys = _keys(docs, id_column, text_column, scratch)
    twice, words = set_twice(keys, scratch)
    maybe, alone = _split(keys, twice, words)
    found = attach(maybe, _groups(maybe, scratch), ["text_sha256"], "left")
    nothing = {"__keep": F.lit(None).cast(keys.schema["__id"].dataType), "__size": F.lit(None).cast("long")}
    alone = alone.withColumns(nothing)
    found = _finished(found.unionByName(alone))
    return found.select(F.col("__id").alias(id_column), *ADDED)


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One whole row of ``docs`` for each different text, that with the largest id; columns stay as they are.

    Rows that the filter clears pass from the scan to the result without a shuffle. Of rows repeated with that id
    any one stays. Nulls, empty texts and empty tables are treated as in ``duplicates``.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    twice, words = set_twice(_keys(docs, id_column, text_column, scratch), scratch)
    digest = F.sha2(normal(text_column).cast("binary"), 256)
    whole = docs.select(F.struct(*docs.columns).alias("__row"), F.col(id_column).alias("__id"), digest.alias("text_sha256"))
    maybe, alone = _split(whole, twice, words)
    found = attach(maybe, _groups(maybe.drop("__row"), scratch), ["text_sha256"], "left")
    stays = found.where(F.col("__size").isNull() | F.col("__id").eqNullSafe(F.col("__keep")))
    chosen = stays.dropDuplicates(["text_sha256"]).drop("__keep", "__size")
    return alone.unionByName(chosen).select("__row.*")
