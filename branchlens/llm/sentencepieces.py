"""Operator 6: SentencePiece encoding and decoding.

Method: an Aho-Corasick automaton over the pieces reads a text once. At each position it
follows its output links through all pieces that end there, longest first, and relaxes the
best score of the position from the scores at the pieces' starts (Viterbi). No piece goes on
after a space, so pre-tokens are encoded one by one and remembered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from branchlens.llm.common import chunks, per_process, read, small_batches
from branchlens.llm.pieces import MODEL, SPACE, Pieces, load_pieces, pre_tokens

REMEMBERED = 150_000  # pre-tokens, then they become the older half of the memory
LONG = 100  # longer pre-tokens are not remembered
_WORST = float("-inf")


class Encoder:
    """Unigram encoding by the pieces' scores.

    Of equal scores, the segmentation whose last piece is longest wins, at every position.
    """

    def __init__(self, pieces: Pieces):
        self.pieces, self.unknown_score = pieces, pieces.unknown_score
        self.automaton = ahocorasick.Automaton()
        for piece, i in pieces.ids.items():
            self.automaton.add_word(piece, (len(piece), pieces.scores[piece], i))
        self.automaton.make_automaton()
        self.single = frozenset(p for p in pieces.ids if len(p) == 1)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _spell(self, char: str) -> list[int]:
        if self.pieces.bytes_from is None:
            return [self.pieces.unknown]
        return [self.pieces.bytes_from + b for b in char.encode("utf-8", "surrogatepass")]

    def _viterbi(self, word: str) -> bytes:
        n = len(word)
        best, back, via = [0.0] + [_WORST] * n, [0] * (n + 1), [-1] * (n + 1)
        odd = not self.single.issuperset(word)  # some character is no piece
        closed = 0  # if odd: positions up to here have their final score
        for last, (size, score, i) in self.automaton.iter(word):
            if odd and last > closed:
                self._close(word, best, back, via, closed, last)
                closed = last
            total = best[last + 1 - size] + score
            if total > best[last + 1]:
                best[last + 1], back[last + 1], via[last + 1] = total, last + 1 - size, i
        if odd:
            self._close(word, best, back, via, closed, n)
        out: list[int] = []
        p = n
        while p:
            if via[p] >= 0:
                out.append(via[p])
            else:
                out.extend(reversed(self._spell(word[p - 1])))
            p = back[p]
        out.reverse()
        return np.array(out, np.int32).tobytes()

    def _close(self, word: str, best: list, back: list, via: list, done: int, to: int) -> None:
        """Where a character is no piece, it may stand for itself at a penalty."""
        for p in range(done + 1, to + 1):
            if word[p - 1] not in self.single and best[p - 1] + self.unknown_score > best[p]:
                best[p], back[p], via[p] = best[p - 1] + self.unknown_score, p - 1, -1

    def word(self, word: str) -> bytes:
        """The ids of a pre-token, four bytes each."""
        ids = self.recent.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self._viterbi(word)
                if len(word) > LONG:
                    return ids
            if len(self.recent) >= REMEMBERED:
                self.older, self.recent = self.recent, {}
            self.recent[word] = ids
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.word, pre_tokens(text))), np.int32)


class Decoder:
    def __init__(self, pieces: Pieces):
        self.parts = [p.replace(SPACE, " ").encode("utf-8", "surrogatepass") for p in pieces.texts]
        if pieces.bytes_from is not None:
            for b in range(256):
                self.parts[pieces.bytes_from + b] = bytes([b])

    def __call__(self, ids: list[int] | None) -> str:
        whole = b"".join([self.parts[i] for i in ids or ()]).decode("utf-8", "replace")
        return whole[1:] if whole.startswith(" ") else whole


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, decoded_sha256, lossless: the piece ids of each whole text, decoded again.

    Scores are those of the model file; a character without a piece is spelled in bytes or,
    if the model has none, becomes the unknown piece. Decoding joins the pieces and takes
    one leading space off. ``lossless`` tells if that gives the text (as it does unless the
    text holds U+2581, or characters that cannot be spelled); decoded_sha256 is of the
    decoded text. A null text is encoded like an empty one: no ids, lossless. One row per
    input row, repeated rows and null ids included; other columns are not looked at; an
    empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.value
        encoder = per_process("encoder", model.digest, lambda: Encoder(model))
        decoder = Decoder(model)
        for batch in batches:
            for part in chunks(batch):
                ids, digests, same, sizes = [], [], [], [0]
                for text in part.column("text").to_pylist():
                    mine = encoder(text)
                    back = decoder(mine.tolist())
                    ids.append(mine)
                    sizes.append(len(mine))
                    digests.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                    same.append(back == (text or ""))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(digests), pa.array(same)],
                    names=["doc_id", "ids", "decoded_sha256", "lossless"],
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded_sha256 string, lossless boolean"
    )


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids give an empty text."""
    pieces = encoded.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pieces.value)
        for batch in batches:
            texts = [decoder(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(read(spark, sf_dir, "documents"))
    return out.selectExpr("doc_id", "cast(size(ids) as long) as n_tokens", "ids", "decoded_sha256", "lossless")
