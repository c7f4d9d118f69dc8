"""Byte-level BPE by replaying the merges over the distinct words of a block of documents.

The text is cut by the pattern of the vocabulary. The distinct words of a block of documents form a
corpus (of at most ``CORPUS_WORDS``, which keeps the index in the processor's caches): an inverted index tells for every rank at which word positions the pair that makes it stands.
Ranks are taken in rising order, each is applied at all its positions, and only the pairs with the two
neighbours of a merged position are entered again. The ids of a document are those of its words. Nothing
shuffles; a Python worker remembers the distinct words it has met, up to ``REMEMBERED`` and a block.

A word that is itself in the vocabulary gets its rank at once, as the tokenizer's own library does.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from onlinecast.llm.common import append, column

BLOCK_WORDS = 400_000
CORPUS_WORDS = 16_384
REMEMBERED = 400_000
LONG_TEXT = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of base64 bytes and a rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Replayer:
    """Applies every merge of a vocabulary, in rank order, to a corpus of distinct words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.made: dict[tuple[int, int], int] = {}
        self.first = np.full((256, 256), -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first[token[0], token[1]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.made[left, right] = rank

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        whole = [self.ranks.get(w) for w in words]
        rest = [w for w, rank in zip(words, whole, strict=True) if rank is None]
        corpora = (rest[i : i + CORPUS_WORDS] for i in range(0, len(rest), CORPUS_WORDS))
        replayed = chain.from_iterable(map(self._replay, corpora))
        return [next(replayed) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def _index(self, data: np.ndarray, ends: np.ndarray) -> dict[int, list[int]]:
        """Positions of the pairs of bytes that make each rank; word k starts at its bytes' offset plus k + 1."""
        if len(data) < 2:
            return {}
        ranks = self.first[data[:-1], data[1:]]
        ranks[ends[:-1] - 1] = -1
        at = np.flatnonzero(ranks >= 0)
        if not len(at):
            return {}
        at = at[np.argsort(ranks[at], kind="stable")]
        found, firsts = np.unique(ranks[at], return_index=True)
        places = at + np.searchsorted(ends, at, "right") + 1
        return {int(r): part.tolist() for r, part in zip(found, np.split(places, firsts[1:]), strict=True)}

    def _replay(self, words: list[bytes]) -> list[bytes]:
        made = self.made
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        # -1 stands between words, and for a position that was merged away
        laid = np.full(len(data) + len(words) + 1, -1, np.int64)
        laid[np.arange(len(data)) + np.searchsorted(ends, np.arange(len(data)), "right") + 1] = self.single[data]
        symbols = laid.tolist()
        before, after = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        index = self._index(data, ends)
        waiting = list(index)
        heapify(waiting)
        while waiting:
            rank = heappop(waiting)
            for at in sorted(index.pop(rank)):
                right = after[at]
                if made.get((symbols[at], symbols[right])) != rank:
                    continue
                symbols[at], symbols[right] = rank, -1
                after[at] = beyond = after[right]
                before[beyond] = at
                left = before[at]
                for first, new in ((left, made.get((symbols[left], rank))), (at, made.get((rank, symbols[beyond])))):
                    if new is None:
                        continue
                    if new in index:
                        index[new].append(first)
                    else:
                        index[new] = [first]
                        heappush(waiting, new)
        ids = np.array(symbols, np.int64)
        live = ids >= 0
        counts = np.concatenate([[0], np.cumsum(live)])
        packed = ids[live].astype("<u4").tobytes()
        begins = counts[np.concatenate([[0], ends[:-1]]) + np.arange(len(words)) + 1] * 4
        limits = counts[ends + np.arange(len(words)) + 1] * 4
        return [packed[i:j] for i, j in zip(begins.tolist(), limits.tolist(), strict=True)]


class Encoder:
    """Ids of texts, with the replayer and the words a Python worker has met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replayer, self.pattern = Replayer(ranks), regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def _cut(self, text: str) -> Iterator[list[str]]:
        """Words of a text; those of a long text in several lists."""
        if len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while words := [m.group() for m in islice(found, BLOCK_WORDS)]:
            yield words

    def _learn(self, lists: list[list[str]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*lists).difference(self.known))
        self.known.update(zip(new, self.replayer.encode([w.encode() for w in new]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if sum(map(len, texts)) <= 4 * LONG_TEXT:
            lists = [self.pattern.findall(t) for t in texts]
            self._learn(lists)
            return [b"".join([self.known[w] for w in words]) for words in lists]
        out = []
        for text in texts:
            parts = []
            for words in self._cut(text):
                self._learn([words])
                parts.append(b"".join([self.known[w] for w in words]))
            out.append(b"".join(parts))
        return out


def encoder(docs: DataFrame, ranks_path: str, pattern: str, text: str) -> Callable[[pa.RecordBatch], list[bytes]]:
    # One state for each Python worker: what it has encoded serves its later tasks.
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(ranks_path)})

    def encode_batch(batch: pa.RecordBatch) -> list[bytes]:
        state = shared.value
        if "encoder" not in state:
            state["encoder"] = Encoder(state["ranks"], pattern)
        return state["encoder"].encode([x or "" for x in column(batch, text).to_pylist()])

    return encode_batch


def decoder(df: DataFrame, ranks_path: str) -> Callable[[list[bytes]], list[bytes]]:
    shared = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(ranks_path).items()})

    def decode_ids(packed: list[bytes]) -> list[bytes]:
        token = shared.value
        return [b"".join([token[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in packed]

    return decode_ids


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Token ids of every text.

    Adds ``n_tokens`` long and ``ids`` binary (little-endian unsigned 32-bit integers). A null or empty text has
    none. Each row is encoded by itself, so repeated rows and ids get equal ids. ``keep`` names the columns
    to carry on (all when None); columns called ``n_tokens`` or ``ids`` are replaced. The file at ``ranks_path``
    is read on the driver and sent to the tasks: it is as large as the vocabulary, whatever the corpus.
    """
    encode_batch = encoder(docs, ranks_path, pattern, text)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids = encode_batch(batch)
        return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}

    return append(docs, "n_tokens long, ids binary", add, keep, text)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Bytes of every list of token ids (as ``encode`` writes them), in a column ``decoded``; null ids give none."""
    decode_ids = decoder(tokens, ranks_path)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        packed = [x or b"" for x in column(batch, ids).to_pylist()]
        return {"decoded": pa.array(decode_ids(packed), pa.binary())}

    return append(tokens, "decoded binary", add, keep, ids)


def digests(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None, ids: bool = False
) -> DataFrame:
    """Encode every text, decode its ids, and add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The digests are lower-case hex, of the ids as ``encode`` packs them and of the decoded bytes. Both
    directions run in one task, so bytes do not leave it, and ids (as a column ``ids``) only when asked for. Nulls and names are as in ``encode``.
    """
    encode_batch, decode_ids = encoder(docs, ranks_path, pattern, text), decoder(docs, ranks_path)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        packed = encode_batch(batch)
        made = {
            "n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64()),
            "ids_sha256": pa.array([sha256(x).hexdigest() for x in packed], pa.string()),
            "decoded_sha256": pa.array([sha256(x).hexdigest() for x in decode_ids(packed)], pa.string()),
        }
        return made | {"ids": pa.array(packed, pa.binary())} if ids else made

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids
    return append(docs, fields, add, keep, text)
