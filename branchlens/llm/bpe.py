"""Operator 11: byte-level BPE encoding and decoding.

Method: corpus-level merge replay. The distinct words (matches of the pre-token pattern) that a
chunk of the corpus adds lie end to end in one array of tokens. An inverted index lists, per
rank, the positions whose pair of tokens merges into it; the merges are replayed in rank order over
all words at once, and each applied merge looks up anew only the pairs with its two neighbours.
A word that is itself a token needs no merge. Words are encoded independently of each other,
so chunks and tasks may be cut anywhere and nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import chunks, per_process, read, small_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
REMEMBERED = 250_000  # words whose ids a worker keeps; beyond it only those of the chunk at hand
REPLAYED = 1 << 20  # bytes of new words in one replay, or one longer word
PART = 2 << 20  # bytes of text in a chunk, or one longer text
_WIDE = 32  # bits that hold a token id
_NONE = -1


@dataclass(frozen=True)
class Ranks:
    tokens: tuple[bytes, ...]  # by rank; None where the file has no such rank
    digest: str  # of the file


def load_ranks(path: str = RANKS) -> Ranks:
    """The tokens of a rank file (bounded by the vocabulary), read on the driver."""
    with open(path, "rb") as file:
        content = file.read()
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, content.splitlines())}
    if {t for t in ranks.values() if len(t) == 1} != {bytes([b]) for b in range(256)}:
        raise ValueError("a rank file must hold all 256 bytes")
    tokens = tuple(ranks.get(i) for i in range(max(ranks) + 1))
    return Ranks(tokens, hashlib.sha256(content).hexdigest())


class Replay:
    """Encodes words by replaying the merges over all of them, in rank order."""

    def __init__(self, ranks: Ranks):
        self.ids = {token: i for i, token in enumerate(ranks.tokens) if token is not None}
        self.pairs: dict[int, int] = {}  # left and right token -> the token they merge into
        for token, i in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << _WIDE | right] = i
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.first = np.full((256, 256), _NONE, np.int64)  # pairs of single bytes
        for token, i in self.ids.items():
            if len(token) == 2:
                self.first[token[0], token[1]] = i

    def __call__(self, words: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        batch: list[bytes] = []
        held = 0
        for word in words:
            batch.append(word)
            held += len(word)
            if held >= REPLAYED:
                yield from self._encoded(batch)
                batch, held = [], 0
        yield from self._encoded(batch)

    def _encoded(self, words: list[bytes]) -> Iterator[bytes]:
        whole = [self.ids.get(w) for w in words]
        merged = self._merged([w for w, i in zip(words, whole, strict=True) if i is None])
        for i in whole:
            yield next(merged) if i is None else i.to_bytes(4, "little")

    def _merged(self, words: list[bytes]) -> Iterator[bytes]:
        sizes = np.array([len(w) for w in words], np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        tokens = array("q", self.of_byte[data].tobytes())
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edges[1:][sizes > 0] - 1] = _NONE
        before[edges[:-1][sizes > 0]] = _NONE
        # pending[p]: the rank that the pair at p merges into; the index lists positions by it.
        pending = np.full(n, _NONE, np.int64)
        inner = np.flatnonzero(after != _NONE)
        pending[inner] = self.first[data[inner], data[inner + 1]] if n > 1 else _NONE
        live = np.flatnonzero(pending != _NONE)
        live = live[np.argsort(pending[live], kind="stable")]
        ranks, starts = np.unique(pending[live], return_index=True)
        index = {int(r): p.tolist() for r, p in zip(ranks, np.split(live, starts[1:]), strict=False)}
        self._apply(
            tokens, array("q", after.tobytes()), array("q", before.tobytes()), array("q", pending.tobytes()), index
        )
        out = np.frombuffer(tokens, np.int64)
        kept = out != _NONE
        ids = out[kept].astype("<u4").tobytes()
        ends = np.concatenate(([0], np.cumsum(kept)))[edges] * 4
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield ids[a:b]

    def _apply(self, tokens: array, after: array, before: array, pending: array, index: dict[int, list[int]]) -> None:
        """All merges, smallest rank first and from left to right; merged-away tokens become _NONE."""
        pairs = self.pairs
        queue = list(index)
        heapify(queue)
        while queue:
            rank = heappop(queue)
            waiting: list[int] = []  # behind a smaller rank that a merge has opened in the same word
            closed = 0  # positions below it wait
            for p in sorted(index.pop(rank)):
                if pending[p] != rank:
                    continue
                if p < closed:
                    waiting.append(p)
                    continue
                q = after[p]
                right, left = after[q], before[p]
                tokens[p], tokens[q] = rank, _NONE
                pending[q] = pending[p] = _NONE
                after[p] = right
                smaller = False
                if right != _NONE:
                    before[right] = p
                    new = pairs.get(rank << _WIDE | tokens[right])
                    if new is not None:
                        pending[p] = new
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heappush(queue, new)
                        smaller = new < rank
                if left != _NONE:
                    new = pairs.get(tokens[left] << _WIDE | rank)
                    if new is None:
                        pending[left] = _NONE
                    else:
                        pending[left] = new
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heappush(queue, new)
                        smaller = smaller or new < rank
                if smaller:
                    closed = p
                    while after[closed] != _NONE:
                        closed = after[closed]
            if waiting:
                index[rank] = waiting
                heappush(queue, rank)


class Encoder:
    """Texts to ids; the words met lately are remembered."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.replay, self.words = Replay(ranks), regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [self.words.findall(t) if t else [] for t in texts]
        here = set().union(*split)
        new = [w for w in here if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {w: self.known[w] for w in here if w in self.known}
        self.known.update(zip(new, self.replay(w.encode() for w in new), strict=True))
        known = self.known
        return [b"".join([known[w] for w in words]) for words in split]


class Decoder:
    def __init__(self, ranks: Ranks):
        self.tokens = ranks.tokens

    def __call__(self, ids: Iterable[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


def _ids(packed: list[bytes]) -> pa.Array:
    """Packed ids as lists of integers."""
    ends = np.cumsum([0, *(len(b) // 4 for b in packed)])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids array<int>: the token ids of every whole text, without special tokens.

    Each match of the pattern is encoded for itself: if it is a token, as that; else its bytes
    are merged, always the adjacent pair with the smallest rank first, the leftmost of equal
    ones. What the pattern does not match is left out. A null or empty text has no ids. One row per
    input row, repeated rows and null ids included; other columns are not looked at; an empty
    table gives an empty table.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            for part in chunks(batch, size=PART):
                packed = encoder(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _ids(packed)], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, bytes of rows (doc_id, ids): the tokens' bytes end to end; null ids give none.

    An id that the vocabulary lacks raises.
    """
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            whole = [decoder(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(whole, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, packed (ids as little-endian unsigned 32-bit integers), bytes (the ids decoded).

    :func:`encode` and :func:`decode` in one pass, which spares moving the ids; rows as there.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(shared.value, pattern), Decoder(shared.value)
        for batch in batches:
            for part in chunks(batch, size=PART):
                packed = encoder(part.column("text").to_pylist())
                whole = [decoder(np.frombuffer(b, "<u4").tolist()) for b in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(packed, pa.binary()), pa.array(whole, pa.binary())],
                    names=["doc_id", "packed", "bytes"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, packed binary, bytes binary")


def _encoder(ranks: Ranks, pattern: str) -> Encoder:
    return per_process("byte encoder", (ranks.digest, pattern), lambda: Encoder(ranks, pattern))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = round_trip(read(spark, sf_dir, "documents"))
    return both.select(
        "doc_id",
        F.expr("cast(octet_length(packed) div 4 as long)").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
