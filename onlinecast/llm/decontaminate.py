"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

Texts are compared as lower-case letters and digits with single spaces between. A window of w characters that
occurs with at most e edits shares at least ``w + 1 - q * (e + 1)`` q-grams with the place it occurs at, all
on diagonals that lie in one of a row of overlapping bands. So the shared q-grams are counted per item,
band and window; windows that reach the bound are aligned within the band, and those within the
edit budget are hits. Documents never shuffle: the benchmark goes to them, in blocks of bounded size, each of
them one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from onlinecast.llm.common import Roller, append, column, row_blocks, text_buffer

GRAM = 10
WINDOW = 80
STEP = 8
RATE = 0.075
BAND = 8
FILTER_BITS = 24
ITEM_BYTES = 4 << 20
PIECE = 1 << 20
MATCHES = 1 << 21
SLICE = 1024
SLICES = 4096

# ASCII letters in lower case and digits stay, other ASCII is a space; bytes of other characters stay
PLAIN = np.full(256, 32, np.uint8)
PLAIN[48:58] = np.arange(48, 58)
PLAIN[97:123] = np.arange(97, 123)
PLAIN[65:91] = np.arange(97, 123)
PLAIN[128:] = np.arange(128, 256)


def plain(data: np.ndarray, offsets: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as they are compared, ``apart`` zero bytes before each, and for each byte its place in ``data`` (or -1)."""
    marks = PLAIN[data]
    after = np.concatenate([[0], data[:-1]]) == 0xC3
    marks[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20  # capitals of Latin-1
    before = np.concatenate([[32], marks[:-1]])
    starts = offsets[:-1][offsets[1:] > offsets[:-1]]
    before[starts[starts < len(data)]] = 32
    kept = np.flatnonzero((marks != 32) | (before != 32))
    row = np.searchsorted(offsets, kept, "right") - 1
    place = np.full(len(kept) + apart * len(offsets), -1, np.int64)
    at = np.arange(len(kept)) + apart * (row + 1)
    out = np.zeros(len(place), np.uint8)
    out[at], place[at] = marks[kept], kept
    return out, place


def plain_pieces(data: np.ndarray, size: int, overlap: int, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A long text as ``plain`` gives it, in pieces of ``size`` bytes of ``data`` with ``overlap`` bytes of the plain text before."""
    text, place = np.zeros(0, np.uint8), np.zeros(0, np.int64)
    edge = np.zeros(apart, np.uint8), np.full(apart, -1, np.int64)
    for at in range(0, len(data), size):
        lead = min(at, 1)  # the byte before tells whether a run of spaces or a letter of two bytes goes on
        part = data[at - lead : at + size]
        marks, kept = plain(part, np.array([0, len(part)]), 0)
        new = kept >= lead
        text = np.concatenate([text[max(len(text) - overlap, 0) :], marks[new]])
        place = np.concatenate([place[max(len(place) - overlap, 0) :], kept[new] + at - lead])
        yield np.concatenate([edge[0], text, edge[0]]), np.concatenate([edge[1], place, edge[1]])


class Passages:
    """Index of a block of benchmark items: their q-grams, and the windows that are searched for."""

    def __init__(self, texts: list[str], q: int = GRAM, window: int = WINDOW, step: int = STEP, rate: float = RATE):
        self.q = q
        rows = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        rows = [plain(r, np.array([0, len(r)]), 0)[0] if len(r) else r for r in rows]
        rows = [r[:-1] if len(r) and r[-1] == 32 else r for r in rows]
        self.begin = np.cumsum([0, *[len(r) for r in rows]])
        self.text = np.concatenate([np.zeros(0, np.uint8), *rows])
        self.window = np.array([min(window, len(r)) for r in rows], np.int64)
        # no more edits than leave one shared q-gram
        self.edits = np.clip(np.minimum((self.window * rate).astype(np.int64), self.window // q - 1), 0, None)
        self.bound = self.window + 1 - q * (self.edits + 1)
        self.widest = int(self.edits.max(initial=0))
        self.starts = [
            np.unique(np.append(np.arange(0, n - w + 1, step), n - w)) if w >= q else np.zeros(0, np.int64)
            for n, w in zip(np.diff(self.begin), self.window, strict=True)
        ]
        roller = Roller()
        places = [np.arange(b, e - q + 1) for b, e in zip(self.begin[:-1], self.begin[1:], strict=True)]
        places = np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int64)
        names = roller.grams(roller.prefix(self.text), q)[places]
        order = np.argsort(names, kind="stable")
        self.names, self.places = names[order], places[order]
        self.item = np.searchsorted(self.begin, self.places, "right") - 1
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def meetings(self, text: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``text`` of the q-grams that the items have, and the range of equal ones in the index."""
        names = roller.grams(roller.prefix(text), self.q)
        at = np.flatnonzero(self.filter[(names >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        lo = np.searchsorted(self.names, names[at], "left")
        return at, lo, np.searchsorted(self.names, names[at], "right")

    def shared(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, its place and the place in the text of every shared q-gram."""
        n = hi - lo
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return self.item[which], self.places[which], np.repeat(at, n)

    def shared_in_parts(
        self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``shared`` in parts of at most about ``MATCHES`` rows; every window of an item has all its rows in one of them."""
        if int((hi - lo).sum()) <= MATCHES:
            yield self.shared(at, lo, hi)
            return
        widest = int(self.window.max())
        size = max(widest, MATCHES // max(1, len(at)) - widest)
        for begin in range(0, len(self.text), size):
            # equal q-grams stand in the index by their place
            ends = [np.array([i + np.searchsorted(self.places[i:j], edge) for i, j in zip(lo.tolist(), hi.tolist(), strict=True)])
                    for edge in (begin, begin + size + widest)]
            yield self.shared(at, *ends)

    def candidates(self, item: np.ndarray, place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, window start and first diagonal of the band of all windows that share enough q-grams in a band."""
        diagonal = at - place
        band = diagonal // BAND
        near = diagonal - band * BAND < self.widest  # these lie in the end of the band before, too
        item = np.concatenate([item, item[near]])
        place = np.concatenate([place, place[near]])
        band = np.concatenate([band, band[near] - 1])
        order = np.lexsort((place, band, item))
        item, place, band = item[order], place[order], band[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(item) != 0) | (np.diff(band) != 0)])) if len(item) else item
        end = np.append(new[1:], len(item))
        enough = end - new >= self.bound[item[new]] if len(item) else np.zeros(0, bool)
        found: list[tuple[int, int, int]] = []
        for i, j in zip(new[enough], end[enough], strict=True):
            k = int(item[i])
            starts, width = self.starts[k], int(self.window[k])
            inside = place[i:j] - self.begin[k]
            count = np.searchsorted(inside, starts + width - self.q, "right") - np.searchsorted(inside, starts, "left")
            found += [(k, int(s), int(band[i]) * BAND) for s in starts[count >= max(1, self.bound[k])]]
        return tuple(np.array(c, np.int64) for c in (zip(*found, strict=True) if found else ([], [], [])))

    def aligned(
        self, text: np.ndarray, item: np.ndarray, start: np.ndarray, first: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edits of the best alignment of each window in its band, and the part of ``text`` that it covers."""
        columns = BAND + self.widest
        offset = np.arange(columns)
        base = self.begin[item] + start + first  # place in the text of row 0, column 0
        padded = np.concatenate([np.zeros(columns, np.uint8), text, np.zeros(columns + 1, np.uint8)])
        unit = 4 * columns  # a cost is its edits times this, plus the column it came from
        cost = np.tile(offset, (len(item), 1)).astype(np.int64)
        big = np.int64(1 << 40)
        best = np.zeros_like(cost)
        for r in range(int(self.window[item].max(initial=0))):
            live = r < self.window[item]
            letter = self.text[np.minimum(self.begin[item] + start + r, len(self.text) - 1)]
            there = padded[np.clip(base[:, None] + r + offset + columns, 0, len(padded) - 1)]
            moved = cost + unit * (there != letter[:, None])
            skipped = np.concatenate([cost[:, 1:] + unit, np.full((len(item), 1), big)], axis=1)
            row = np.minimum(moved, skipped)
            row = np.minimum.accumulate(row - unit * offset, axis=1) + unit * offset
            cost = np.where(live[:, None], row, cost)
        best = cost.argmin(1)
        least = cost[np.arange(len(item)), best]
        return least // unit, base + least % unit, base + self.window[item] + best

    def hits(self, data: np.ndarray, offsets: np.ndarray, roller: Roller) -> list[tuple[int, int, int, int, int]]:
        """Row, item, first and last byte (past the end) in ``data``, and edits of each window found."""
        if not len(self.names) or not len(data):
            return []
        return self.hits_of(*plain(data, offsets, self.widest + 1), offsets, roller)

    def hits_of(
        self, text: np.ndarray, place: np.ndarray, offsets: np.ndarray, roller: Roller
    ) -> list[tuple[int, int, int, int, int]]:
        """``hits`` in a text that is plain already."""
        met = self.meetings(text, roller)
        if int((met[2] - met[1]).sum()) <= MATCHES:
            spans = [self.spans(text, self.candidates(*self.shared(*met)))]
        else:
            spans = self.spans_of_slices(text, roller)
        out = []
        for hits in spans:
            for k, e, a, b in zip(*hits, strict=True):
                inside = place[max(a, 0) : b]
                inside = inside[inside >= 0]
                if len(inside):
                    row = int(np.searchsorted(offsets, inside[0], "right")) - 1
                    out.append((row, int(k), int(inside[0]), int(inside[-1]) + 1, int(e)))
        return out

    def spans(self, text: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """Item, edits, start and end in ``text`` of the candidates that are windows within their edits."""
        parts = [tuple(np.zeros(0, np.int64) for _ in range(4))]
        for i in range(0, len(found[0]), 20_000):
            item, start, first = (c[i : i + 20_000] for c in found)
            edits, lo, hi = self.aligned(text, item, start, first)
            near = edits <= self.edits[item]
            parts.append((item[near], edits[near], lo[near], hi[near]))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def spans_of_slices(self, text: np.ndarray, roller: Roller) -> Iterator[tuple[np.ndarray, ...]]:
        """``spans`` of a text with very many shared q-grams, slice by slice.

        Slices overlap by more than a window and its band, so that each window lies in one; they begin at multiples
        of ``BAND``, so that equal slices have equal bands and are searched once. Spans of an item that overlap are one.
        """
        overlap = int(self.window.max()) + 2 * (BAND + self.widest + 1)
        step = -(-SLICE // BAND) * BAND
        known: dict[bytes, tuple[np.ndarray, ...]] = {}
        for begin in range(0, len(text), step):
            part = text[begin : begin + step + overlap]
            name = part.tobytes()
            if name not in known:
                if len(known) >= SLICES:
                    known.clear()
                rows = self.shared_in_parts(*self.meetings(part, roller))
                spans = [self.spans(part, self.candidates(*row)) for row in rows]
                spans = tuple(np.concatenate(c) for c in zip(*spans, strict=True))
                # between rows there are zeros, which a span may reach into
                known[name] = spans if (part == 0).any() else joined(*spans)
            item, edits, lo, hi = known[name]
            yield item, edits, lo + begin, hi + begin


def joined(item: np.ndarray, edits: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of an item that overlap as one, with the fewest edits."""
    order = np.lexsort((hi, lo, item))
    item, edits, lo, hi = item[order], edits[order], lo[order], hi[order]
    shift = item * (int(hi.max(initial=0)) + int(-lo.min(initial=0)) + 1)
    reach = np.maximum.accumulate(hi + shift) if len(hi) else hi
    new = np.flatnonzero(np.concatenate([[True], (lo + shift)[1:] >= reach[:-1]])[: len(item)])
    if not len(new):
        return item, edits, lo, hi
    return item[new], np.minimum.reduceat(edits, new), lo[new], np.maximum.reduceat(hi, new)


def merged(found: list[tuple[int, int, int, int]]) -> list[dict]:
    """Overlapping hits (item, start, end, edits) of an item as one, with the fewest edits of its windows."""
    out: list[dict] = []
    for item, start, end, edits in sorted(set(found)):
        if out and out[-1]["item"] == item and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
            out[-1]["edits"] = min(out[-1]["edits"], edits)
        else:
            out.append({"item": item, "start": start, "end": end, "edits": edits})
    return out


def item_blocks(benchmark: DataFrame, key: str, text: str) -> list[list]:
    """Items (key, text) in blocks of about ``ITEM_BYTES``; the caller takes one block at a time."""
    items = benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    return [items.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "item_id", item_text: str = "text",
    q: int = GRAM, window: int = WINDOW, step: int = STEP, rate: float = RATE, name: str = "hits",
) -> DataFrame:
    """``docs`` with a column ``name``: the items that each text holds, in order of item and place.

    A hit has ``item_id``, ``start`` and ``end`` in bytes of the UTF-8 text, and ``edits``. An item is held if one
    of its windows (of ``window`` characters, every ``step`` from its begin and at its end; the whole item if it
    is shorter) occurs with at most ``rate`` edits per character, and so few that a q-gram must be shared.
    Items with fewer than ``q`` characters and null items are never found; a null or empty text holds none.
    Hits of an item that overlap are one. Repeated rows get the same hits, repeated items are one, of equal texts with
    several ids each is reported. A column of that name is replaced, all others are kept.
    """
    id_type = benchmark.schema[key].dataType.simpleString()
    kind = T.ArrayType(T.StructType.fromDDL(f"`{key}` {id_type}, start long, end long, edits int"))
    out = docs.drop(name)
    columns = list(out.columns)
    parts: list[str] = []
    for block, items in enumerate(item_blocks(benchmark, key, item_text)):
        rows = sorted(items.collect(), key=lambda r: (r["key"] is None, r["key"], r["text"]))  # about ITEM_BYTES
        shared = docs.sparkSession.sparkContext.broadcast([r["text"] for r in rows])
        keys = [r["key"] for r in rows]
        state: dict = {}

        part = f"__hits{block}"

        def add(batch: pa.RecordBatch, part=part, shared=shared, keys=keys, state=state) -> dict[str, pa.Array]:
            if not state:
                state["passages"], state["roller"] = Passages(shared.value, q, window, step, rate), Roller()
            passages, roller = state["passages"], state["roller"]
            data, offsets = text_buffer(column(batch, text))
            found: list[list] = [[] for _ in range(len(batch))]
            overlap = 4 * window + 4 * passages.widest
            for first, last in row_blocks(offsets, PIECE):
                begin, end = int(offsets[first]), int(offsets[last])
                bounds = offsets[first : last + 1] - begin
                if end - begin <= PIECE:
                    hits = passages.hits(data[begin:end], bounds, roller)
                elif not len(passages.names):
                    hits = []
                else:
                    # a long text is taken in pieces that overlap by more than any window, both as they are compared
                    pieces = plain_pieces(data[begin:end], PIECE, overlap, passages.widest + 1)
                    hits = [hit for piece in pieces for hit in passages.hits_of(*piece, bounds, roller)]
                for row, item, lo, hi, edits in hits:
                    shift = begin - int(offsets[first + row])
                    found[first + row].append((item, lo + shift, hi + shift, edits))
            lists = [[{**hit, key: keys[hit.pop("item")]} for hit in merged(f)] for f in found]
            return {part: pa.array(lists, to_arrow_type(kind))}

        out = append(out, f"{part} {kind.simpleString()}", add, None, text)
        parts.append(part)
    hits = F.array_sort(F.concat(*parts)) if parts else F.array().cast(kind)
    return out.select(*columns, hits.alias(name))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per hit: ``key``, ``item_id``, ``start``, ``end`` and ``edits``."""
    marked = with_hits(docs.select(key, text), benchmark, text, item)
    return marked.select(key, F.explode("hits").alias("hit")).select(key, "hit.*")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` without the rows that hold an item."""
    marked = with_hits(docs, benchmark, text, item, name="__found")
    return marked.where(F.size("__found") == 0).select(*docs.columns)
