"""Operator 7: document fingerprints by consistent weighted sampling.

Method: the terms of a text are its words, weighted by their counts. For each of SAMPLES
samples, a term of weight S draws r and c from Gamma(2, 1) and b from U(0, 1), all fixed by
term and sample, and takes t = floor(ln S / r + b), y = exp(r (t - b)), a = c / (y exp(r)); the
term with the least a and its t are the sample. Two texts share a sample with the
probability of their generalised Jaccard similarity (sum of minima over sum of maxima).
All draws come from a 64-bit hash of the word itself; a worker keeps those of the words met lately.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchlens.llm.common import mix, read, shuffle_partitions, staged
from branchlens.llm.jaccard import word_hashes

SAMPLES = 64
KEPT = 1 << 16  # words whose draws a worker remembers
TERMS = 1024  # terms worked on at once
STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW, _NAME = np.uint64((1 << 32) - 1), np.uint64(32)
_SIGN, _DRAWN = np.uint32(1 << 31), np.uint64((1 << 25) - 1)


def _draws(hashes: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b for each word and sample, from two 64-bit hashes of (word, sample): five numbers of 25 bits."""
    with np.errstate(over="ignore"):
        one = mix(hashes[:, None] + mix(np.arange(samples, dtype=np.uint64) + np.uint64(1)))
        two = mix(one + STEP)

    def uniform(bits: np.ndarray) -> np.ndarray:
        return ((bits & _DRAWN).astype(np.float64) + 0.5) * (1.0 / (1 << 25))

    r = -np.log(uniform(one) * uniform(one >> np.uint64(25)))
    log_c = np.log(-np.log(uniform(two) * uniform(two >> np.uint64(25))))
    b = uniform((one >> np.uint64(50) << np.uint64(11)) ^ (two >> np.uint64(50)))
    # Below 1, also as a short float: its floor must be 0.
    return r.astype(np.float32), log_c.astype(np.float32), np.minimum(b, 1 - 2.0**-24).astype(np.float32)


def _keys(a: np.ndarray, names: np.ndarray) -> np.ndarray:
    """One number for ln a and the name of (term, t): numbers sort as the ln a do, then by name."""
    bits = a.view(np.uint32)
    ordered = np.where(bits & _SIGN, ~bits, bits | _SIGN)
    return ordered.astype(np.uint64) << _NAME | names & _LOW


class Memory:
    """Draws of the words met lately: a word has one place, by its hash, and takes it from the word before.

    A text, the edited one before it and its own share most of their words, so few words
    are drawn for twice.
    """

    def __init__(self, samples: int):
        self.hashes = np.full(KEPT, ~np.uint64(0))
        self.one = np.empty((KEPT, samples), np.uint64)  # keys for weight 1
        self.draws = np.empty((KEPT, 3, samples), np.float32)  # r, ln c, b

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes % np.uint64(KEPT)).astype(np.int64)

    def keep(self, hashes: np.ndarray, one: np.ndarray, draws: np.ndarray) -> None:
        places, first = np.unique(self.place(hashes), return_index=True)
        self.hashes[places], self.one[places], self.draws[places] = hashes[first], one[first], draws[first]


_kept = lru_cache(maxsize=1)(Memory)


def _least(hashes: np.ndarray, one: np.ndarray, draws: np.ndarray, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
    """The least keys of some terms, given their counts; ``one`` holds them for a count of 1, where t = 0."""
    if len(one):
        best = np.minimum(best, one.min(axis=0))
    if len(counts):
        r, log_c, b = draws.swapaxes(0, 1)
        t = np.floor(np.log(counts).astype(np.float32)[:, None] / r + b)
        with np.errstate(over="ignore"):
            names = mix(hashes[:, None] + t.astype(np.int64).astype(np.uint64) * STEP)
        best = np.minimum(best, _keys(log_c - r * (t - b + 1), names).min(axis=0))
    return best


class Sampler:
    def __init__(self, samples: int):
        self.samples = samples
        self.memory = _kept(samples)

    def __call__(self, text: str | None) -> np.ndarray:
        """One number per sample; all zero only for a text without characters."""
        if not text:
            return np.zeros(self.samples, np.uint16)
        data = text.encode("utf-8", "surrogatepass")
        words, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        if not len(words):
            words = np.array([xxhash.xxh3_64_intdigest(data)], np.uint64)
        terms, counts = np.unique(words, return_counts=True)
        best = np.full(self.samples, ~np.uint64(0))
        for start in range(0, len(terms), TERMS):
            best = self._less(terms[start : start + TERMS], counts[start : start + TERMS], best)
        return (mix((best & _LOW) + np.uint64(1)) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)

    def _less(self, h: np.ndarray, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        memory = self.memory
        at = memory.place(h)
        known, many = memory.hashes[at] == h, counts > 1
        some = known & many
        best = _least(h[some], memory.one[at[known & ~many]], memory.draws[at[some]], counts[some], best)
        if known.all():
            return best
        new, n = h[~known], counts[~known]
        r, log_c, b = _draws(new, self.samples)
        draws = np.stack((r, log_c, b), axis=1)
        one = _keys(log_c - r * (np.float32(1) - b), mix(new)[:, None])
        memory.keep(new, one, draws)
        return _least(new[n > 1], one[n == 1], draws[n > 1], n[n > 1], best)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


FIELDS = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "mine": pa.binary(),
    "edited": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
ROW = "doc_id long, n_chars long, edited_sha256 string, mine binary, edited binary, near_edited double, near_next double"
RESULT, HEAD, TAIL = 0, 1, 2


def _compared(sampler: Sampler, doc_id: int | None, text: str, mine: np.ndarray, after: str, its: np.ndarray) -> tuple:
    changed = edited(text, after)
    other = sampler(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    packed = (x.astype(">u2").tobytes() for x in (mine, other))
    return doc_id, len(text), digest, *packed, likeness(mine, other), likeness(mine, its)


def _neighbours(samples: int):
    """Sorted rows of one range: each row with the one after it, and the range's first and last rows."""

    names = ["part", "role", "text", *FIELDS]
    types = [pa.int32(), pa.int32(), pa.string(), *FIELDS.values()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, last, nothing = Sampler(samples), None, (None,) * (len(FIELDS) - 1)
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "text"))
            for part, doc_id, text in zip(*columns, strict=True):
                mine = sampler(text)
                if last is None:
                    rows.append((part, HEAD, text, doc_id, *nothing))
                else:
                    rows.append((part, RESULT, None, *_compared(sampler, *last[1:], text, mine)))
                last = (part, doc_id, text, mine)
            if rows:
                yield batch_of(rows)
        if last:
            yield batch_of([(last[0], TAIL, last[2], last[1], *nothing)])

    return run


def _across(samples: int):
    """Last rows of the ranges with the first row behind each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for batch in batches:
            rows = []
            for doc_id, text, after in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "after")), strict=True):
                rows.append(_compared(sampler, doc_id, text, sampler(text), after, sampler(after)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), FIELDS.values(), strict=True)],
                    names=list(FIELDS),
                )

    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each whole text's fingerprint, and how like it is to the edited text's and the next one's.

    doc_id, n_chars (code points), edited_sha256, fingerprint and edited_fingerprint (four hex
    digits per sample), near_edited, near_next (share of equal samples). Words are runs without
    blanks (0x20, 0x09-0x0D), A-Z lowered; a text without words is one term; the empty text (or null) is like
    another empty one alone. The next document is the next by doc_id (equal ids: by a hash of the text, then by text;
    null ids first), after the last comes the first; a lone document is its own next. One
    row per input row; other columns are not looked at; an empty table gives an empty table.

    The documents are sorted into ranges of ids, and each range is read once in order. Only
    the first and last rows of the ranges meet again, in a join of one row per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = 2 * shuffle_partitions(spark)
    done = staged(
        # The text's hash splits rows of equal or no id over the ranges.
        rows.repartitionByRange(ranges, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(_neighbours(samples), f"part int, role int, text string, {ROW}"),
        "neighbours",
    )
    heads = done.where(F.col("role") == HEAD).select("part", F.col("text").alias("after"))
    tails = done.where(F.col("role") == TAIL).select("part", "doc_id", "text")
    order = Window.orderBy("part")  # one small row per range
    behind = heads.select(
        "part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next")
    )
    across = (
        tails.join(behind, "part")
        .join(heads.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "text", "after")
        .mapInArrow(_across(samples), ROW)
    )
    out = done.where(F.col("role") == RESULT).select(*FIELDS).union(across)
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("mine")).alias("fingerprint"),
        F.lower(F.hex("edited")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
