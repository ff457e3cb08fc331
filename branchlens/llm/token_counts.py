"""Operator 1: token counts, by dynamic programming over a trie of pre-tokens.

Method: the distinct pre-tokens that a chunk of the corpus adds make a trie, walked depth first.
Each node holds the best unigram score of the text from the root to it, that segmentation's number of
tokens, and the pieces that have begun and may go on; all of it is computed once from
the parent, however many pre-tokens share the prefix. A pre-token's count is read off at its
terminal node and remembered. Texts never leave their task, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from branchlens.llm.common import chunks, per_process, read, small_batches
from branchlens.llm.pieces import MODEL, Pieces, load_pieces, pre_tokens

REMEMBERED = 300_000  # pre-tokens whose counts a worker keeps; beyond it only those of the chunk at hand
PART = 4 << 20  # bytes of text in a chunk, or one longer text
_WORST = float("-inf")


class PieceTrie:
    """All pieces by their characters: a node is a dict of its children, its score under None if it ends a piece."""

    def __init__(self, scores: dict[str, float]):
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for char in piece:
                node = node.setdefault(char, {})
            node[None] = score


class CountTrie:
    """Counts the tokens of the best-scoring segmentation of pre-tokens.

    Of equal scores, the segmentation whose last piece is longest wins, at every prefix.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = PieceTrie(pieces.scores).root
        self.unknown_score, self.bytes = pieces.unknown_score, pieces.bytes_from is not None
        self.known: dict[str, int] = {}

    def _unknown(self, char: str) -> int:
        return len(char.encode("utf-8", "surrogatepass")) if self.bytes else 1

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """Each word with its count. The words in order make a depth-first walk of their trie.

        The lists hold the nodes of the path: score, count and begun pieces by depth. A step
        to the next word goes back to the last common node.
        """
        pieces = self.pieces
        best, tokens, begun = [0.0], [0], [[]]
        before = ""
        for word in sorted(words):
            depth, most = 0, min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del best[depth + 1 :], tokens[depth + 1 :], begun[depth + 1 :]
            for char in word[depth:]:
                score, count, on = best[-1], tokens[-1], []
                top, least = _WORST, 0
                # Pieces that began earlier, hence longer ones, come first.
                for node, base, n in begun[-1]:
                    node = node.get(char)
                    if node is not None:
                        on.append((node, base, n))
                        end = node.get(None)
                        if end is not None and base + end > top:
                            top, least = base + end, n + 1
                node = pieces.get(char)
                if node is not None:
                    on.append((node, score, count))
                    end = node.get(None)
                    if end is not None and score + end > top:
                        top, least = score + end, count + 1
                if (node is None or None not in node) and score + self.unknown_score > top:
                    top, least = score + self.unknown_score, count + self._unknown(char)
                best.append(top)
                tokens.append(least)
                begun.append(on)
            yield word, tokens[-1]
            before = word

    def __call__(self, words: set[str]) -> dict[str, int]:
        """Counts of the words and others."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {w: self.known[w] for w in words if w in self.known}
        self.known.update(self.walk(new))
        return self.known

    def count(self, word: str) -> int:
        return self({word})[word]


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens: the tokens of each whole text's best unigram segmentation.

    The scores are those of the model file. Characters without a piece count one token per
    UTF-8 byte if the model spells them in bytes, else one. A null or empty text has no
    tokens. One row per input row, repeated rows and null ids included; other columns are not
    looked at; an empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces.value
        trie = per_process("count trie", model.digest, lambda: CountTrie(model))
        for batch in batches:
            for part in chunks(batch, size=PART):
                words = [pre_tokens(t) for t in part.column("text").to_pylist()]
                counts = trie(set().union(*words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(ws) for ws in words], pa.int64()),
                        pa.array([sum(map(counts.__getitem__, ws)) for ws in words], pa.int64()),
                    ],
                    names=["doc_id", "n_pre_tokens", "n_tokens"],
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_pre_tokens long, n_tokens long"
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
