"""Phrases of words that stand together more often than chance, counted by sorting suffixes.

A suffix pointer is a place in a piece of text with the words from there on, at most ``LONGEST``. Only places whose words
can begin a frequent phrase are kept: words and then pairs of words are counted first, and bitmaps of a fixed size say
which may be frequent (a false answer costs work, never results). Equal suffixes of a slice of text are sent once, with
their number. Pointers are routed by their language and two leading words; where these stand at more than ``HOT`` places, by
four leading words. Each bucket is sorted by multikey three-way quicksort down to
the last word. The part equal to the pivot at some depth is a phrase and its size the count; parts below the least count
are abandoned where all their pointers are in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onlinecast.llm.common import ODD, Roller, Scratch, column, mix, row_blocks, text_buffer, words_of
from onlinecast.plans.joins import attach

LONGEST = 5
LEAST = 100
FIRST = 2000
HOT = 1 << 20
SLICE_BYTES = 8 << 20
HASH_BYTES = 1 << 20
SEND_ROWS = 1 << 16
BUCKET_PLACES = 1 << 19
FILTER_BITS = 26
SALTS = 256
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~BREAKS
WORD[[0x20, 0x09]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of a slice of documents: text, place, hash with the language, and whether the next word is of the same piece.

    Texts are taken in blocks of ``HASH_BYTES``, since hashing holds many numbers for each byte.
    """

    def __init__(self, batch: pa.RecordBatch, roller: Roller):
        data, offsets = text_buffer(column(batch, "__text"))
        self.data, offsets = LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
        langs = np.array([v or "und" for v in column(batch, "__lang").to_pylist()], object)
        self.langs, codes = np.unique(langs, return_inverse=True)
        salts = np.array([hash_text(v) for v in self.langs], np.uint64)
        parts = []
        for top, bottom in row_blocks(offsets, HASH_BYTES):
            begin = offsets[top]
            block = self.data[begin : offsets[bottom]]
            row, first, last = words_of(block, offsets[top : bottom + 1] - begin, WORD)
            lang = codes[top:bottom][row]
            hashed = mix(roller.spans(roller.prefix(block), first, last) ^ salts[lang])
            broken = np.concatenate([[0], np.cumsum(BREAKS[block], dtype=np.int32)])
            follows = np.zeros(len(row), bool)
            follows[:-1] = (row[1:] == row[:-1]) & (broken[first[1:]] == broken[last[:-1]])
            parts.append((first + begin, last + begin, lang.astype(np.int32), hashed, follows))
        self.first, self.last, self.lang, self.hash, self.follows = (np.concatenate(x) for x in zip(*parts, strict=True))

    def pairs(self) -> np.ndarray:
        """Hash of each word with the next one."""
        after = np.concatenate([self.hash[1:], np.zeros(1, np.uint64)])[: len(self.hash)]
        return mix(self.hash * np.uint64(ODD) + after)


def hash_text(text: str) -> int:
    """A number of 64 bits for a language; equal in every task."""
    value = 1469598103934665603
    for byte in text.encode():
        value = ((value ^ byte) * 1099511628211) % 2**64
    return value


class Filter:
    """Bitmap of hashes, of ``2 ** FILTER_BITS`` bits whatever it holds."""

    def __init__(self, hashes: DataFrame):
        place = F.shiftrightunsigned("__hash", 64 - FILTER_BITS)
        bit = F.expr("shiftleft(1L, cast(__place & 63 as int))")
        packed = hashes.select(place.alias("__place")).groupBy(F.shiftrightunsigned("__place", 6).alias("word"))
        found = packed.agg(F.bit_or(bit).alias("bits")).toArrow()
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        self.bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in row_blocks(text_buffer(column(batch, "__text"))[1], SLICE_BYTES):
            yield batch.slice(first, last - first)


def _word_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of each word in each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(13)
        for batch in _slices(batches):
            words = Words(batch, roller)
            hashes, where, n = np.unique(words.hash, return_index=True, return_counts=True)
            text = [words.data[words.first[i] : words.last[i]].tobytes() for i in where]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(words.langs[words.lang[where]], pa.string()),
                "phrase": pa.array(text, pa.binary()).cast(pa.string()),
                "__hash": pa.array(hashes.view(np.int64)),
                "n": pa.array(n, pa.int64()),
            })

    parts = texts.mapInArrow(run, "lang string, phrase string, __hash long, n long")
    return parts.groupBy("lang", "phrase", "__hash").agg(F.sum("n").alias("n"))


def _pair_counts(texts: DataFrame, frequent) -> DataFrame:
    """Places of each pair of words that may be frequent, by the pair's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(13)
        for batch in _slices(batches):
            words = Words(batch, roller)
            good = frequent.value.holds(words.hash)
            both = words.follows & good
            both[:-1] &= good[1:]
            hashes, n = np.unique(words.pairs()[both], return_counts=True)
            yield pa.RecordBatch.from_pydict({"__hash": pa.array(hashes.view(np.int64)), "n": pa.array(n, pa.int64())})

    return texts.mapInArrow(run, "__hash long, n long").groupBy("__hash").agg(F.sum("n").alias("n"))


def _pointers(texts: DataFrame, frequent, hot, buckets: int) -> DataFrame:
    """Different suffixes of each slice with their number, packed by bucket and language.

    A suffix ends before the first pair of words that is not frequent: no phrase beyond it can be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(13)
        for batch in _slices(batches):
            words = Words(batch, roller)
            pairs, n = words.pairs(), len(words.hash)
            linked = words.follows & frequent.value.holds(pairs)
            end = np.arange(n)  # last word of the suffix
            for _ in range(LONGEST - 1):
                end = np.where(linked[end], np.minimum(end + 1, n - 1), end)
            at = np.flatnonzero(linked)
            many = hot.value.holds(pairs[at])
            whole, led = words.hash[at], pairs[at]
            for step in range(1, LONGEST):
                inside = at + step <= end[at]
                whole = np.where(inside, mix(whole * np.uint64(ODD) + words.hash[np.minimum(at + step, n - 1)]), whole)
                if step == 3:
                    led = np.where(many, whole, led)
            _, where, times = np.unique(whole, return_index=True, return_counts=True)
            bucket = (mix(led) % np.uint64(buckets)).astype(np.int64)[where]
            group = (bucket * 2 + many[where]) * len(words.langs) + words.lang[at[where]]
            order = np.argsort(group, kind="stable")
            for begin in range(0, len(order), SEND_ROWS):
                some = order[begin : begin + SEND_ROWS]
                edges = np.flatnonzero(np.diff(group[some])) + 1
                bounds = pa.array(np.concatenate([[0], edges, [len(some)]]), pa.int32())
                some_at, head = at[where[some]], some[np.concatenate([[0], edges])]
                suffixes = pa.ListArray.from_arrays(bounds, _joined(words, some_at, end[some_at] + 1 - some_at))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[head]),
                    "complete": pa.array(np.where(many[where[head]], 4, 2).astype(np.int32)),
                    "lang": pa.array(words.langs[words.lang[at[where[head]]]], pa.string()),
                    "suffixes": pc.binary_join(suffixes, "\n"),
                    "n": pa.ListArray.from_arrays(bounds, pa.array(times[some], pa.int64())),
                })

    return texts.mapInArrow(run, "bucket long, complete int, lang string, suffixes string, n array<bigint>")


def _joined(words: Words, at: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Texts of ``lengths`` words from each place ``at`` on, with one space between words."""
    stops = np.cumsum(lengths)
    word = np.arange(stops[-1]) + np.repeat(at - (stops - lengths), lengths)
    later = np.ones(len(word), np.int64)
    later[stops - lengths] = 0
    ends = np.cumsum(words.last[word] - words.first[word] + later)
    begins = np.concatenate([[0], ends[:-1]])
    data = words.data[np.arange(ends[-1]) + np.repeat(words.first[word] - later - begins, ends - begins)]
    data[begins[later == 1]] = 0x20
    bounds = np.concatenate([[0], ends[stops - 1]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(bounds), pa.py_buffer(data))


def sorted_counts(codes: np.ndarray, weights: np.ndarray, complete: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """A pointer, depth and count of each phrase: multikey three-way quicksort of the rows of ``codes``.

    ``codes`` holds a code for each word of a suffix, -1 behind its end; its first column is the language. Parts of fewer
    than ``least`` pointers are abandoned once a depth is ``complete`` for them, that is when no other bucket has any.
    """
    todo = [(np.arange(len(codes)), 0)]
    deepest = codes.shape[1]
    while todo:
        part, depth = todo.pop()
        if weights[part].sum() < (least if (complete[part] <= depth).all() else 1):
            continue
        letter = codes[part, depth]
        pivot = int(np.median(letter[[0, len(letter) // 2, -1]]))
        same = letter == pivot
        if not same.all():
            todo += [(side, depth) for side in (part[letter < pivot], part[letter > pivot]) if len(side)]
            part = part[same]
        if pivot < 0 or not len(part):
            continue
        size = int(weights[part].sum())
        if size < (least if (complete[part] <= depth).all() else 1):
            continue
        if depth >= 2:
            yield int(part[0]), depth, size
        if depth + 1 < deepest:
            todo.append((part, depth + 1))


def _bucket_counts(pointers: DataFrame, least: int) -> DataFrame:
    """Counts of phrases within each bucket of pointers."""

    def count(table: pa.Table) -> pa.Table:
        packed = pc.split_pattern(table["suffixes"].combine_chunks(), "\n")
        times = packed.value_lengths().to_numpy().astype(np.int64)
        lists = pc.split_pattern(packed.flatten(), " ")
        words = lists.flatten().dictionary_encode()
        length = lists.value_lengths().to_numpy().astype(np.int64)
        langs = table["lang"].combine_chunks().dictionary_encode()
        codes = np.full((len(length), LONGEST + 1), -1, np.int64)
        codes[:, 0] = np.repeat(langs.indices.to_numpy(), times)
        row = np.repeat(np.arange(len(length)), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        codes[row, place + 1] = words.indices.to_numpy()
        complete = np.repeat(table["complete"].to_numpy(), times)
        weights = table["n"].combine_chunks().flatten().to_numpy()
        found = list(sorted_counts(codes, weights, complete, least))
        names, langs = words.dictionary.to_pylist(), langs.dictionary.to_pylist()
        return pa.table({
            "lang": pa.array([langs[codes[i, 0]] for i, _, _ in found], pa.string()),
            "phrase": pa.array([" ".join(names[c] for c in codes[i, 1 : d + 1]) for i, d, _ in found], pa.string()),
            "n": pa.array([n for _, _, n in found], pa.int64()),
        })

    return pointers.groupBy("bucket").applyInArrow(count, "lang string, phrase string, n long")


def phrase_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Words of each language with all their occurrences, and phrases of 2 to 5 words with at least ``least``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    texts = docs.select(F.col(text_column).alias("__text"), F.col(lang_column).cast("string").alias("__lang"))
    words = scratch.write(_word_counts(texts), "words")
    known = spark.sparkContext.broadcast(Filter(words.where(F.col("n") >= least)))
    pairs = scratch.write(_pair_counts(texts, known).where(F.col("n") >= least), "pairs")
    known.unpersist()
    frequent = spark.sparkContext.broadcast(Filter(pairs))
    hot = spark.sparkContext.broadcast(Filter(pairs.where(F.col("n") > HOT)))
    places = pairs.agg(F.sum("n")).first()[0] or 0
    pointers = _pointers(texts, frequent, hot, max(1, -(-places // BUCKET_PLACES)))
    parts = scratch.write(_bucket_counts(pointers, least), "parts")
    frequent.unpersist()
    hot.unpersist()
    phrases = parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return words.select("lang", "phrase", "n"), scratch.write(phrases, "counts")


def collocations(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, first: int = FIRST
) -> DataFrame:
    """The ``first`` phrases of each language by how much more often they stand together than chance.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs. Of each
    phrase of 2 to ``LONGEST`` words with at least ``least`` occurrences ``a`` the weakest cut into two parts with ``l`` and ``r``
    occurrences counts: score floor(1000 a n / (l r)) with ``n`` words of the language, exactly; ties go to the shorter first
    part. Phrases inside a longer one that is as frequent leave. Ranks go by score and ``a``, descending, then by the phrase.

    Null and empty texts have no words, a null language is ``und``, repeated rows count each time, an empty table gives no
    rows. Long texts are read whole, one row at a time. Other columns of ``docs`` are not read.
    """
    words, phrases = phrase_counts(docs, text_column, lang_column, least)
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    counts = words.where(F.col("n") >= least).unionByName(phrases)
    cut = phrases.withColumn("__words", F.split("phrase", " ")).select(
        "lang", "phrase", "__words", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size(__words) - 1)")).alias("k")
    )
    part = lambda start, size: F.array_join(F.slice("__words", start, size), " ")
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("__left"), part(F.col("k") + 1, F.size("__words")).alias("__right"))
    for side, name in (("__left", "l"), ("__right", "r")):
        cut = attach(cut, counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cut = attach(cut, total, ["lang"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumns({"__over": (F.col("a") * 1000).cast("decimal(19,0)") * wide("total"), "__under": wide("l") * wide("r")})
    cut = cut.withColumn("score", F.expr("__over div __under"))
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("__cut")
    scored = cut.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(least_cut)
    scored = scored.select("lang", "phrase", "a", "__cut.l", "__cut.r", "n", "__cut.score")
    within = phrases.withColumn("__words", F.split("phrase", " ")).withColumn("__size", F.size("__words"))
    within = within.where("__size > 2").select("lang", "n", "__words", "__size", F.explode(F.expr("sequence(2, __size - 1)")).alias("__k"))
    within = within.select("lang", "n", F.explode(F.expr("transform(sequence(1, __size - __k + 1), i -> array_join(slice(__words, i, __k), ' '))")).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("n").alias("__longer"))
    scored = scored.join(within, ["lang", "phrase"], "left").where("coalesce(100 * __longer, 0) < 100 * a").drop("__longer")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    scored = scored.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order)))
    best = best.where(F.col("rank") <= first)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
