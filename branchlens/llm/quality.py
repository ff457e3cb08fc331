"""Operator 10: a quality classifier, by a factorisation machine.

Method: a text's features are its hashed words (shares of all words), statistics of its
structure, and its declared length. A logistic factorisation machine scores them: a weight per
feature plus a low-rank interaction of every pair of features, which the identity
sum over pairs <vi, vj> xi xj = 1/2 sum over factors ((sum vi xi)^2 - sum (vi xi)^2)
makes linear in the number of features. It is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import chunks, read, staged

WORDS = 1 << 14  # classes of hashed words
FACTORS = 8
TRAIN_ROWS = 8_000  # labelled rows that the model is fitted on, at most
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-6
HELD_OUT = 5  # rows whose crc32(doc_id) is 0 modulo this are never used for fitting
THRESHOLD = 0.3
SYMBOLS = "#$%&*|!@^~_=+<>{}[]\\/"
STATISTICS = (
    "bias log_chars log_words log_lines upper digits blanks symbols stops long_words short_words distinct_words "
    "repeated_lines line_words symbol_words top_word capital_words length_gap no_length"
).split()
FEATURES = "doc_id long, classes array<int>, shares array<float>, stats array<float>"


class Features:
    def __init__(self):
        self.known: dict[str, int] = {}

    def _class(self, word: str) -> int:
        i = self.known.get(word)
        if i is None:
            if len(self.known) > 500_000:
                self.known.clear()
            i = self.known[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS
        return i

    def __call__(self, text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word classes, their shares, and the statistics, all of them bounded."""
        text = text or ""
        words, lines = text.split(), text.split("\n")
        counts = Counter(words)
        n, size = max(1, len(words)), max(1, len(text))
        classes: Counter[int] = Counter()
        for w, c in counts.items():
            classes[self._class(w)] += c
        used = {c: text.count(c) for c in SYMBOLS}
        marks = sum(used.values())
        digits = sum(map(text.count, "0123456789"))
        blanks = text.count(" ") + text.count("\n") + text.count("\t")
        letters = len(words) and sum(map(len, counts)) / len(counts)
        upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
        heads = sum(c for w, c in counts.items() if w[0].isupper())
        odd = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?\"')")
        stats = [
            1.0,
            np.log1p(size) / 10,
            np.log1p(n) / 10,
            np.log1p(len(lines)) / 10,
            upper / n,
            digits / size,
            blanks / size,
            min(1.0, 5 * marks / size),
            min(1.0, 5 * text.count(".") / n),
            min(2.0, letters / 10),
            sum(c for w, c in counts.items() if len(w) <= 3) / n,
            len(counts) / n,
            1 - len(set(lines)) / len(lines),
            min(1.0, n / len(lines) / 100),
            odd / n,
            max(counts.values(), default=0) / n,
            heads / n,
            0.0 if n_chars is None else min(1.0, abs(n_chars - len(text)) / size),
            float(n_chars is None),
        ]
        at = np.fromiter(classes.keys(), np.int32, len(classes))
        share = np.fromiter(classes.values(), np.float32, len(classes)) / np.float32(n)
        return at, np.sqrt(share), np.array(stats, np.float32)


class Machine:
    """Weights of all features; statistics come after the word classes."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    @classmethod
    def empty(cls, seed: int = 7) -> Machine:
        n = WORDS + len(STATISTICS)
        return cls(0.0, np.zeros(n), np.random.default_rng(seed).normal(0, 0.05, (n, FACTORS)))

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        return float(self.bias + self.w[at] @ x + 0.5 * ((vx.sum(axis=0) ** 2).sum() - (vx**2).sum()))

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(at, x), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> None:
        """Logistic loss by AdaGrad over shuffled batches; the same rows give the same model."""
        random = np.random.default_rng(seed)
        gw, gv, gb = np.full(self.w.shape, 1e-8), np.full(self.v.shape, 1e-8), 1e-8
        for _ in range(EPOCHS):
            order = random.permutation(len(rows))
            for start in range(0, len(order), BATCH):
                batch = order[start : start + BATCH]
                at = np.concatenate([rows[i][0] for i in batch])
                x = np.concatenate([rows[i][1] for i in batch])
                ends = np.cumsum([0, *(len(rows[i][0]) for i in batch)])[:-1]
                of = np.repeat(np.arange(len(batch)), np.diff([*ends, len(at)]))
                vx = self.v[at] * x[:, None]
                sums = np.add.reduceat(vx, ends, axis=0)
                squares = np.add.reduceat(vx**2, ends, axis=0)
                raw = self.bias + np.add.reduceat(self.w[at] * x, ends) + 0.5 * (sums**2 - squares).sum(axis=1)
                error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]
                some, where = np.unique(at, return_inverse=True)
                dw, dv = np.zeros(len(some)), np.zeros((len(some), FACTORS))
                np.add.at(dw, where, error[of] * x)
                np.add.at(dv, where, (error[of] * x)[:, None] * (sums[of] - vx))
                dw = dw / len(batch) + DECAY * self.w[some]
                dv = dv / len(batch) + DECAY * self.v[some]
                db = error.mean()
                gw[some] += dw**2
                gv[some] += dv**2
                gb += db**2
                self.w[some] -= RATE * dw / np.sqrt(gw[some])
                self.v[some] -= RATE * dv / np.sqrt(gv[some])
                self.bias -= RATE * db / np.sqrt(gb)


def _joined(at: np.ndarray, x: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.concatenate((at, np.arange(WORDS, WORDS + len(stats)))),
        np.concatenate((x, stats)).astype(np.float64),
    )


def _remainder() -> str:
    return f"coalesce(crc32(cast(doc_id as string)) % {HELD_OUT}, 0)"


def sample_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, quality of at most ``rows`` labelled documents outside the held-out part.

    Those with the smallest hash of their id; of contradicting labels for one id the lower.
    """
    fit = labels.where(f"quality is not null and doc_id is not null and {_remainder()} != 0")
    return (
        fit.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fit on the bounded sample; its features are a few hundred numbers per row."""
    chosen = staged(sample_labels(labels, rows), "labels")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at, share, stats = make(r["text"], r["n_chars"])
                out.append({"doc_id": r["doc_id"], "quality": r["quality"], "classes": at.tolist(), "shares": share.tolist(), "stats": stats.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    shape = pa.schema(
        [("doc_id", pa.int64()), ("quality", pa.int32()), ("classes", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32())), ("stats", pa.list_(pa.float32()))]
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_chars").cast("long").alias("n_chars"))
    examples = (
        texts.join(F.broadcast(chosen), "doc_id")  # at most TRAIN_ROWS rows of two numbers
        .mapInArrow(featured, "doc_id long, quality int, classes array<int>, shares array<float>, stats array<float>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("quality", "classes", "shares", "stats")).alias("row"))  # one per id
        .select("doc_id", "row.*")
    )

    def fitted(table: pa.Table) -> pa.Table:
        machine, got = Machine.empty(), table.sort_by("doc_id").to_pylist()
        machine.fit(
            [_joined(np.array(r["classes"], np.int64), np.array(r["shares"]), np.array(r["stats"])) for r in got],
            np.array([r["quality"] for r in got], np.float64),
        )
        return pa.table({"bias": [machine.bias], "w": [machine.w.astype(np.float64).tobytes()], "v": [machine.v.astype(np.float64).tobytes()]})

    model = examples.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fitted, "bias double, w binary, v binary").first()
    if model is None:
        return Machine.empty()
    return Machine(model["bias"], np.frombuffer(model["w"]).copy(), np.frombuffer(model["v"]).reshape(-1, FACTORS).copy())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on) for each whole text.

    A null or empty text is scored by its statistics, a null n_chars by a feature of its own.
    A null doc_id counts as held out. One row per input row, repeated rows too; lang, source
    and other columns are not looked at; an empty table gives an empty table. Without any
    labels every score is near one half.
    """
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, model = Features(), Machine(*shared.value)
        for batch in batches:
            for part in chunks(batch):
                scores = [
                    model.score(*_joined(*make(t, n)))
                    for t, n in zip(part.column("text").to_pylist(), part.column("n_chars").to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_chars").cast("long").alias("n_chars"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.expr(f"{_remainder()} = 0").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))
