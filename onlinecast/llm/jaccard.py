"""Jaccard self-join on word shingles by vertical partitioning.

Documents with equal shingle sets form one class. The shingles are cut into fragments of about equal size;
a fragment holds all occurrences of its shingles, so it counts how often each occurs without a global table, and
answers each block of classes in one row. A class of which more than a quarter of the shingles occur nowhere else
has no partner and leaves. Shingles that very many classes have are known from a first pass and not counted
there. What is left is put in one global order, rare ones first; two classes that link must share one of the first
few (the prefix filter), and meet under the smallest class that has it.

Classes that meet are compared in blocks: the global order of a block's shingles is cut into fragments of
``COLUMNS``, the overlaps of all its pairs are counted in each fragment apart (a product of 0/1 matrices) and
summed per pair. A block returns one edge per linked class, never pairs. First a class goes to one block only,
where it shares most; then the shingles that still stand in several components bring all blocks of their classes
together, which leaves the components exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import (
    Roller, Scratch, append, column, frugal, give_back, mix, row_blocks, small_side, text_buffer, words_of,
)
from onlinecast.llm.components import components
from onlinecast.plans.tables import is_scan

WORDS = 5
PERCENT = 75
FRAGMENT_BYTES = 8 << 20
SEEN = 200_000
CUT_GRAMS = 1_500_000
CUT_CLASSES = 60_000
BLOCK = 256
BLOCK_TOKENS = 1 << 20
COLUMNS = 4096
TURNS = 1
OFTEN_LEAST = 16
HOT_LEAST = 1_000

WORD = np.ones(256, bool)
WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
GRAM_BYTES = 6


def shingle_sets(values: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole text is one if it has fewer words."""
    roller = Roller()
    data, offsets = text_buffer(values)
    for first, last in row_blocks(offsets):
        begin, end = offsets[first], offsets[last]
        lowered = LOWER[data[begin:end]]
        rows, starts, ends = words_of(lowered, offsets[first : last + 1] - begin, WORD)
        word = roller.spans(roller.prefix(lowered), starts, ends)
        bounds = np.searchsorted(rows, np.arange(last - first + 1))
        n = max(0, len(word) - words + 1)
        gram = np.zeros(n, np.uint64)
        for k in range(words):
            gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + word[k : k + n])
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            if j - i >= words:
                yield np.unique(gram[i : j - words + 1])
            elif j > i:
                whole = np.array([j - i], np.uint64)
                for k in range(i, j):
                    whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + word[k : k + 1])
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def class_of(grams: np.ndarray) -> int:
    """Name of a shingle set."""
    place = np.arange(1, len(grams) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([np.add.reduce(mix(grams + place)) + np.uint64(len(grams))], np.uint64)).astype(np.int64)[0])


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of shingles and class of every row (empty texts have none).

    The first row of each block of texts also tells, in ``often``, which shingles a fiftieth of the block's classes have.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets = list(shingle_sets(column(batch, text)))
        names = [class_of(s) if len(s) else None for s in sets]
        found = {name: grams for name, grams in zip(names, sets, strict=True) if name is not None}
        often: list = [None] * len(sets)
        if found:
            grams, n = np.unique(np.concatenate(list(found.values())), return_counts=True)
            many = n >= max(OFTEN_LEAST, len(found) / 50)
            pairs = zip(grams[many].view(np.int64).tolist(), n[many].tolist(), strict=True)
            often[0] = [{"gram": g, "n": k} for g, k in pairs] or None
        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "class": pa.array(names, pa.int64()),
            "often": pa.array(often, pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))),
        }

    fields = "n_shingles long, class long, often array<struct<gram:bigint,n:bigint>>"
    return append(docs.select(key, text), fields, add, [key], text)


def hot_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles that about a hundredth of all classes have, sorted: at most a hundred times those of a mean text."""
    counted = rows.where("often is not null").select(F.explode("often").alias("o")).groupBy("o.gram").agg(F.sum("o.n").alias("n"))
    least = max(HOT_LEAST, rows.where(F.col("class").isNotNull()).count() // 100)
    return np.sort(np.array([r[0] for r in counted.where(F.col("n") >= least).select("gram").collect()], np.int64).view(np.uint64))


def cut(docs: DataFrame, fragments: int, hot: np.ndarray, text: str = "text") -> DataFrame:
    """Shingles by fragment: for a block of classes and a fragment, whose they are and the shingles, packed.

    A task sends a class once, however many copies of it there are; a copy in another task only makes shingles look
    shared that are not, which keeps more. Hot shingles need no counting: they go to fragments from ``fragments`` on,
    dealt by block, so that none of them gathers anywhere. Fragments below 0 hold names and sizes of a block's classes.
    A block is named by its task and number, so ``docs`` must read the same rows in the same order if a task is repeated.
    """
    known = docs.sparkSession.sparkContext.broadcast(hot)

    def packed(block: int, names: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        fragment = (mix(grams ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(fragments)).astype(np.int64)
        fragment[np.isin(grams, known.value)] = fragments + block % fragments
        order = np.argsort(fragment, kind="stable")
        fragment, grams, owner = fragment[order], grams[order], owner[order].astype("<u2")
        found, begins = np.unique(fragment, return_index=True)
        rows = [(-1 - block % fragments, sizes.astype("<i4").tobytes(), np.array(names, "<i8").tobytes())]
        for f, begin, end in zip(found.tolist(), begins, np.append(begins[1:], len(grams)), strict=True):
            short = grams[begin:end].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES]
            rows.append((f, owner[begin:end].tobytes(), short.tobytes()))
        number, owners, values = zip(*rows, strict=True)
        columns = [pa.array(number, pa.int32()), pa.array([block] * len(rows), pa.int64())]
        columns += [pa.array(owners, pa.binary()), pa.array(values, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["fragment", "block", "owners", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        seen: set[int] = set()
        names: list[int] = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for grams in shingle_sets(column(batch, text)):
                name = class_of(grams)
                if not len(grams) or name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                names.append(name)
                sets.append(grams)
                held += len(grams)
                if held >= CUT_GRAMS or len(names) >= CUT_CLASSES:
                    yield packed(block, names, sets)
                    block, names, sets, held = block + 1, [], [], 0
        if sets:
            yield packed(block, names, sets)

    return docs.select(text).mapInArrow(frugal(run), "fragment int, block long, owners binary, grams binary")


def shared(packed: DataFrame, fragments: int, percent: int) -> DataFrame:
    """``class``, ``size`` and ``tokens`` of the classes of which ``percent`` of the shingles occur elsewhere, too.

    A token stands for such a shingle in the global order. It is the logarithm of the number of times it occurs, the
    fragment and a rank, from high bits to low; hot shingles come last, by their hash. A fragment answers each block in
    one row.
    """

    def rank(table: pa.Table) -> pa.Table:
        give_back()
        fragment = table.column("fragment")[0].as_py()
        schema = pa.schema([("block", pa.int64()), ("named", pa.bool_()), ("owners", pa.binary()), ("tokens", pa.binary())])
        blocks, owners, grams = (table.column(c).to_pylist() for c in ("block", "owners", "grams"))
        if fragment < 0:
            return pa.table([blocks, [True] * len(blocks), owners, grams], schema=schema)
        raw = np.frombuffer(b"".join(grams), np.uint8).reshape(-1, GRAM_BYTES)
        gram = np.zeros((len(raw), 8), np.uint8)
        gram[:, :GRAM_BYTES] = raw
        gram = gram.view("<u8").ravel()
        if fragment >= fragments:
            several, tokens = np.ones(len(gram), bool), np.int64(255 << 55) | gram.astype(np.int64)
        else:
            _, place, times = np.unique(gram, return_inverse=True, return_counts=True)
            ranked = np.empty(len(times), np.int64)
            ranked[np.argsort(times, kind="stable")] = np.arange(len(times)) - (times == 1).sum()
            level = np.ceil(4 * np.log2(times)).astype(np.int64)
            several = times[place] > 1
            tokens = ((level << 55) | np.int64(fragment << 31) | ranked)[place]
        out, end = [], 0
        for block, whose, mine in zip(blocks, owners, grams, strict=True):
            begin, end = end, end + len(mine) // GRAM_BYTES
            some = several[begin:end]
            if some.any():
                out.append((block, False, np.frombuffer(whose, "<u2")[some].tobytes(), tokens[begin:end][some].tobytes()))
        return pa.table(list(map(list, zip(*out, strict=True))) if out else [[], [], [], []], schema=schema)

    def gather(table: pa.Table) -> pa.Table:
        give_back()
        named = table.column("named").to_numpy()
        owners, tokens = table.column("owners").to_pylist(), table.column("tokens").to_pylist()
        first = int(np.flatnonzero(named)[0])
        size, names = np.frombuffer(owners[first], "<i4"), np.frombuffer(tokens[first], "<i8")
        owner = np.frombuffer(b"".join(o for k, o in enumerate(owners) if k != first), "<u2")
        token = np.frombuffer(b"".join(t for k, t in enumerate(tokens) if k != first), "<i8")
        enough = np.bincount(owner, minlength=len(names)) * 100 >= size.astype(np.int64) * percent
        owner, token = owner[enough[owner]], token[enough[owner]]
        order = np.lexsort((token, owner))
        owner, token = owner[order], token[order]
        own, begins = np.unique(owner, return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(token)).astype(np.int32)), pa.array(token))
        return pa.table({"class": pa.array(names[own]), "size": pa.array(size[own]), "tokens": lists})

    ranked = packed.groupBy("fragment").applyInArrow(rank, "block long, named boolean, owners binary, tokens binary")
    whole = ranked.groupBy("block").applyInArrow(gather, "class long, size int, tokens array<long>")
    return whole.groupBy("class").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"))


def prefixes(kept: DataFrame, percent: int) -> DataFrame:
    """First tokens of each class, one row each: what any partner must share one of."""
    rare = F.col("size") - F.size("tokens")
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1 - rare
    first = F.explode(F.slice("tokens", F.lit(1), length.cast("int"))).alias("token")
    return kept.select("class", "size", F.size("tokens").alias("n_tokens"), first)


def overlaps(owner: np.ndarray, token: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared tokens of each row of ``left`` with each other of ``right``: counted per fragment of the order and summed."""
    n = max(left.max(), right.max()) + 1
    row = np.full((2, n), -1)
    row[0, left], row[1, right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    at = np.cumsum(np.concatenate([[0], np.diff(token) != 0]))
    alone = np.bincount(at)[at] < 2
    owner, at = owner[~alone], at[~alone]
    _, at = np.unique(at, return_inverse=True)
    total = np.zeros((len(left), len(right)), np.int64)
    width = int(at[-1]) + 1 if len(at) else 0
    for begin in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(at, [begin, begin + COLUMNS])
        sides = []
        for side, rows in ((0, left), (1, right)):
            here = row[side, owner[lo:hi]]
            matrix = np.zeros((len(rows), min(COLUMNS, width - begin)), np.float32)
            matrix[here[here >= 0], at[lo:hi][here >= 0] - begin] = 1
            sides.append(matrix)
        total += (sides[0] @ sides[1].T).astype(np.int64)
    return total


def compared(members: DataFrame, kept: DataFrame, found: DataFrame | None, percent: int) -> DataFrame:
    """An edge (u, v) for each class that links with another component's within a block; u and v are components' classes.

    ``members`` has lead, low, high, own and class: the rows of a block pair, those of block low against those of high.
    """

    def compare(table: pa.Table) -> pa.Table:
        names, component = table.column("class").to_numpy(), table.column("component").to_numpy()
        size, own = table.column("size").to_numpy().astype(np.int64), table.column("own").to_numpy()
        lists = table.column("tokens").combine_chunks()
        token = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(names)), lists.value_lengths().to_numpy())
        left, right = (np.flatnonzero(own == table.column(c)[0].as_py()) for c in ("low", "high"))
        edges = (names[:0], names[:0])
        if len(left) and len(right) and component.min() < component.max():
            both = overlaps(owner, token, left, right)
            near = both * 100 >= percent * (size[left][:, None] + size[right][None, :] - both)
            i, j = np.nonzero(near & (component[left][:, None] != component[right][None, :]))
            a, b = component[left[i]], component[right[j]]
            nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
            a, b = ends[: len(a)], ends[len(a) :]
            least = np.arange(len(nodes))
            while True:
                before = least.copy()
                np.minimum.at(least, a, before[b])
                np.minimum.at(least, b, before[a])
                least = least[least]
                if (least == before).all():
                    break
            moved = least != np.arange(len(nodes))
            edges = nodes[moved], nodes[least[moved]]
        return pa.table({"u": pa.array(edges[0], pa.int64()), "v": pa.array(edges[1], pa.int64())})

    rows = members.join(kept, "class")
    if found is not None:
        rows = rows.join(found.withColumnRenamed("node", "class"), "class", "left")
    component = F.col("class") if found is None else F.coalesce("component", "class")
    rows = rows.withColumn("component", component)
    return rows.groupBy("lead", "low", "high").applyInArrow(compare, "u long, v long")


def with_blocks(members: DataFrame) -> DataFrame:
    """``members`` (lead, class, n_tokens) with the number of blocks of their lead, and their own."""
    many = F.greatest(F.count("*") / BLOCK, F.sum("n_tokens") / BLOCK_TOKENS)
    sizes = members.groupBy("lead").agg(F.ceil(many).cast("int").alias("blocks"))
    return members.join(sizes, "lead").withColumn("own", F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int"))


def one_block_each(met: DataFrame) -> DataFrame:
    """Each class in a block of the lead with which it shares most of its tokens; the lead is in all its blocks."""
    shares = met.where("lead <> class").groupBy("class", "n_tokens", "lead").agg(F.count("*").alias("n"))
    best = shares.groupBy("class", "n_tokens").agg(F.max_by("lead", F.struct("n", "lead")).alias("lead"))
    dealt = with_blocks(best)
    leads = dealt.select("lead", "own").distinct().select("lead", F.col("lead").alias("class"), "own")
    rows = dealt.select("lead", "class", "own").union(leads)
    return rows.select("lead", "class", "own", F.col("own").alias("low"), F.col("own").alias("high"))


def all_blocks(met: DataFrame) -> DataFrame:
    """Each class under all its leads, in all pairs of its block with another."""
    dealt = with_blocks(met.select("lead", "class", "n_tokens").distinct())
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "lead", "class", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )


def contracted(found: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after ``edges`` between components, or classes that had none."""
    more = components(edges).select("node", F.col("component").alias("to"))
    moved = found.join(more.select(F.col("node").alias("component"), "to"), "component", "left")
    moved = moved.select("node", F.coalesce("to", "component").alias("component"))
    return moved.union(more.join(found, "node", "left_anti").select("node", F.col("to").alias("component")))


def class_links(
    docs: DataFrame, rows: DataFrame, scratch: Scratch, text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``node`` and ``component`` of every class that is similar to another; ``rows`` are the classes of ``docs``."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    fragments = max(8, -(-size // FRAGMENT_BYTES))
    kept = scratch.write(shared(cut(docs, fragments, hot_shingles(rows), text), fragments, percent), "kept")
    prefix = prefixes(kept, percent)
    least = prefix.groupBy("token").agg(F.min(F.struct("size", "class")).alias("lead"), F.count("*").alias("n"))
    least = least.where("n > 1").select("token", F.col("lead.class").alias("lead"))
    prefix = scratch.write(prefix.join(least, "token"), "prefix")
    links = scratch.write(compared(one_block_each(prefix), kept, None, percent), "links0")
    found = scratch.write(components(links), "components0")

    for turn in range(1, TURNS + 2):
        # tokens that still stand in several components
        placed = prefix.drop("lead").join(found.withColumnRenamed("node", "class"), "class", "left")
        placed = placed.withColumn("component", F.coalesce("component", "class"))
        chosen = F.min_by("class", F.xxhash64("class", F.lit(turn))).alias("lead")
        mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), chosen)
        met = scratch.write(prefix.drop("lead").join(mixed.where("lo < hi").select("token", "lead"), "token"), f"met{turn}")
        members = one_block_each(met) if turn <= TURNS else all_blocks(met)
        links = scratch.write(compared(members, kept, found, percent), f"links{turn}")
        if not links.isEmpty():
            found = scratch.write(contracted(found, links), f"components{turn}")
    scratch.drop("kept", "prefix", *(f"met{k}" for k in range(1, TURNS + 2)), *(f"links{k}" for k in range(TURNS + 2)))
    return found


def linked(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row.

    Two rows link when ``100 * shared >= percent * union`` of their distinct shingles; ``component_id`` is the
    smallest key that links lead to, the row's own included. Texts that are null or have no word have no
    shingles and link with nothing. A row without key takes part but gives no name; a key that repeats counts
    as often as it stands there, and an empty table gives an empty one. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(key, text)
    docs = docs if is_scan(docs) else scratch.write(docs, "docs")
    rows = scratch.write(classes(docs, key, text), "classes")
    found = class_links(docs, rows, scratch, text, percent)
    least = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(key).alias("least"))
    least = least.join(found.withColumnRenamed("node", "class"), "class", "left")
    least = least.withColumn("component", F.coalesce("component", "class"))
    named = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.write(least.join(named, "component").select("class", "component_id"), "named")
    out = rows.drop("often").join(named, "class", "left")
    alone = F.when(F.col("class").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(key, "n_shingles", alone.alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows whose key is not the smallest of their component. Rows without key stay."""
    found = linked(docs, key, text, percent)
    away = found.where(F.col(key) != F.col("component_id")).select(key).distinct()
    scratch = Scratch(docs.sparkSession, "jaccard-away")
    return docs.join(small_side(scratch.write(away, "away")), key, "left_anti").select(*docs.columns)
