"""A SentencePiece vocabulary with unigram scores, read from a model file on the driver."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import sentencepiece

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # an unknown character scores this much less than the worst piece
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


@dataclass(frozen=True)
class Pieces:
    ids: dict[str, int]
    scores: dict[str, float]
    bytes_from: int | None  # id of byte 0, if unknown characters are spelled in bytes
    unknown: int
    texts: tuple[str, ...]
    digest: str  # of the model file

    @property
    def unknown_score(self) -> float:
        return min(self.scores.values()) - UNKNOWN_PENALTY

    @property
    def longest(self) -> int:
        return max(map(len, self.ids))


def load_pieces(path: str = MODEL) -> Pieces:
    """The pieces of a model file (some ten thousand short strings, bounded by the vocabulary)."""
    with open(path, "rb") as file:
        content = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    ids, scores, first_byte = {}, {}, None
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            first_byte = i if first_byte is None else first_byte
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[model.id_to_piece(i)] = i
            scores[model.id_to_piece(i)] = model.get_score(i)
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError("pieces that go on after a space are not supported")
    texts = tuple(model.id_to_piece(i) for i in range(model.vocab_size()))
    return Pieces(ids, scores, first_byte, model.unk_id(), texts, hashlib.sha256(content).hexdigest())


def pre_tokens(text: str | None) -> list[str]:
    """Runs of spaces with the text up to the next space; no piece crosses their borders.

    Spaces and U+2581 are the same here, and one is put before the text. Empty: none.
    """
    if not text:
        return []
    return _RUNS.findall(SPACE + text.replace(" ", SPACE))
