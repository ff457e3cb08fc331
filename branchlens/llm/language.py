"""Operator 2: language identification by Bayesian evidence fusion.

Method: four pieces of evidence meet in one posterior per text. The text's likelihood under
each language comes from hashed four-byte grams, counted over all rows with a declared
language. The prior of a host is shrunk towards that of its address suffix, and that
towards the whole corpus; all three are grouped sums of what the texts alone say. A markup
declaration weighs by how often texts of each language carry it. A hypothesis
"und" (grams equally likely) stands for text in no known language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import chunks, forget, join_hot, read, small_batches, staged

CLASSES = 1 << 15  # of grams
GRAM = 4
PART = 1 << 20  # bytes of text worked on at once
TEMPER = 1.0 / GRAM  # each byte stands in four grams
SMOOTH = 0.5  # added to each class of each language
PSEUDO = 20.0  # documents that a parent's prior counts for
UND, UND_PRIOR = "und", 1e-3
LANGUAGES = 256  # languages at most; more raise an error
MARKUP = r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})"


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The class of the gram at each byte, and the texts' offsets; A-Z count as a-z."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.int64), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    data = np.concatenate((data, np.zeros(GRAM - 1, np.uint32)))
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        gram = sum(data[i : i + n] << np.uint32(8 * i) for i in range(GRAM)) * np.uint32(0x9E3779B1)
    return (gram >> np.uint32(32 - 15)).astype(np.int64), offsets - offsets[0]


def _spans(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Where each text's whole grams begin and end."""
    return [(a, max(a, b - GRAM + 1)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, class, n): counts of one task, so hot languages shrink before the shuffle."""
    forget()
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in chunks(batch, size=PART):
            classes, offsets = _grams(part.column("text"))
            for lang, (a, b) in zip(part.column("lang").to_pylist(), _spans(offsets), strict=True):
                if lang not in counts:
                    counts[lang] = np.zeros(CLASSES, np.int64)
                if b - a > CLASSES // 8:
                    counts[lang] += np.bincount(classes[a:b], minlength=CLASSES)
                else:
                    np.add.at(counts[lang], classes[a:b], 1)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])],
            names=["lang", "class", "n"],
        )
    forget()


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and ln p(class | language) with one column each; from all rows (text, lang).

    The model has CLASSES x languages numbers however large the corpus is.
    """
    small_batches(rows.sparkSession)
    counts = staged(
        rows.where("text is not null and lang is not null")
        .select("text", F.lower("lang").alias("lang"))
        .mapInArrow(_counted, "lang string, class int, n long")
        .groupBy("lang", "class")
        .agg(F.sum("n").alias("n")),
        "gram-counts",
    )
    languages = [r[0] for r in counts.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if len(languages) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    languages.sort()
    table = np.full((CLASSES, len(languages)), SMOOTH)
    got = counts.toArrow()  # at most CLASSES x LANGUAGES rows
    where = {lang: i for i, lang in enumerate(languages)}
    table[got["class"].to_numpy(), [where[x] for x in got["lang"].to_pylist()]] += got["n"].to_numpy()
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def likelihoods(rows: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str]) -> DataFrame:
    """The columns of ``keep`` with n_grams and ll: tempered ln p(text | language), "und" last."""
    shared = rows.sparkSession.sparkContext.broadcast(model[1])
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [np.ascontiguousarray(shared.value[:, i]) for i in range(shared.value.shape[1])]
        for batch in batches:
            for part in chunks(batch, size=PART):
                classes, offsets = _grams(part.column("text"))
                spans = np.array(_spans(offsets)).reshape(-1, 2)
                n = spans[:, 1] - spans[:, 0]
                out = np.empty((len(n), len(table) + 1))
                for i, column in enumerate(table):
                    sums = np.concatenate(([0.0], np.cumsum(column[classes], dtype=np.float64)))
                    out[:, i] = (sums[spans[:, 1]] - sums[spans[:, 0]]) * TEMPER
                out[:, -1] = n * -np.log(CLASSES) * TEMPER
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(n, pa.int64()), lists], names=[*keep, "n_grams", "ll"]
                )
        forget()

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "n_grams long, ll array<double>"
    return rows.select(*keep, "text").mapInArrow(run, schema)


def _softmax(scores: str) -> str:
    top = f"array_max({scores})"
    return f"transform({scores}, x -> exp(x - {top}) / aggregate({scores}, 0D, (s, y) -> s + exp(y - {top})))"


def _sums(n: int) -> Column:
    return F.array(*(F.sum(F.col("alone")[i]) for i in range(n))).alias("sums")


def fuse(scored: DataFrame, languages: list[str], keep: list[str]) -> DataFrame:
    """The columns of ``keep`` with language, probability, accepted, n_grams.

    ``scored`` has ll and n_grams (see ``likelihoods``), host, suffix and declared. Each of these
    may be null: all without a host, or suffix, share one; a missing declaration says
    nothing. A text shorter than one gram is "und" and not accepted, whatever its host.
    """
    names = [*languages, UND]
    size = len(names)
    scored = scored.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "suffix", "declared")})
    flat = "array(" + ", ".join(["0D"] * (size - 1) + [f"{float(np.log(UND_PRIOR))!r}D"]) + ")"
    alone = _softmax(f"zip_with(ll, {flat}, (a, b) -> a + b)")
    scored = staged(scored.withColumn("alone", F.expr(alone)), "likelihoods")
    counted = scored.where("n_grams > 0")
    total = max(1, scored.count())
    whole = counted.agg(_sums(size)).first()["sums"]
    base = np.array([x or 0.0 for x in whole]) + 0.5
    base = base / base.sum()
    root = "array(" + ", ".join(f"{x!r}D" for x in map(float, base)) + ")"
    shrunk = lambda parent: f"transform(sums, (x, i) -> (x + {PSEUDO}D * {parent}[i]) / (n + {PSEUDO}D))"
    # Both are sums over documents, made before the shuffle; hosts may be as many as rows.
    hosts = staged(counted.groupBy("suffix", "host").agg(_sums(size), F.count("*").alias("n")), "hosts")
    suffixes = (
        hosts.groupBy("suffix")
        .agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(size))).alias("sums"), F.sum("n").alias("n"), F.count("*").alias("hosts"))
        .select("suffix", F.expr(shrunk(root)).alias("parent"), "hosts")
    )
    priors = join_hot(hosts, suffixes, ["suffix"], "hosts", total).select(
        "suffix", "host", F.expr(shrunk("parent")).alias("prior"), F.col("n").alias("documents")
    )
    declared = (
        counted.where("declared != ''")
        .groupBy("declared")
        .agg(_sums(size), F.count("*").alias("n"))
    )
    both = counted.where("declared != ''").agg(_sums(size), F.count("*").alias("n")).first()
    marks = "array(" + ", ".join(f"{float(x or 0.0)!r}D" for x in both["sums"]) + ")"
    share = f"(n / {max(1, both['n'])}D)"
    claims = declared.select(
        "declared",
        F.expr(f"transform(sums, (x, i) -> ln((x + {share}) / ({marks}[i] + 1D)))").alias("claim"),
        F.col("n").alias("claims"),
    )
    known = join_hot(scored, priors, ["suffix", "host"], "documents", total, "left")
    known = join_hot(known, claims, ["declared"], "claims", total, "left")
    nothing = "array(" + ", ".join(["0D"] * size) + ")"
    fused = F.expr(
        f"zip_with(zip_with(ll, transform(coalesce(prior, {root}), x -> ln(x)), (a, b) -> a + b), "
        f"coalesce(claim, {nothing}), (a, b) -> a + b)"
    )
    labels = F.array(*map(F.lit, names))
    result = known.withColumn("fused", fused).withColumn("posterior", F.expr(_softmax("fused")))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    language = F.when(F.col("n_grams") > 0, labels[best - 1]).otherwise(F.lit(UND))
    return result.select(
        *keep,
        language.alias("language"),
        F.when(F.col("n_grams") > 0, F.array_max("posterior")).otherwise(F.lit(0.0)).alias("probability"),
        (language != UND).alias("accepted"),
        "n_grams",
    )


def addresses(pages: DataFrame) -> DataFrame:
    """doc_id, host, suffix, declared: where a crawl met a document, by the number in the address.

    Of several pages the one with the smallest page_id counts.
    """
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    number = F.regexp_extract("url", r"^[^?#]*/(\d{1,18})(?:\.[a-z]+)?/?(?:[?#].*)?$", 1)
    found = pages.select(
        "page_id",
        number.alias("number"),
        host.alias("host"),
        F.lower(F.regexp_extract("html", MARKUP, 1)).alias("declared"),
    ).where("number != ''")
    best = found.groupBy(F.col("number").cast("long").alias("doc_id")).agg(
        F.min_by(F.struct("host", "declared"), F.struct("page_id", "host", "declared")).alias("p")
    )
    return best.select(
        "doc_id", "p.host", F.regexp_extract("p.host", r"\.([^.]+)$", 1).alias("suffix"), "p.declared"
    )


def identify_documents(docs: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """doc_id, th (hash of the text), language, probability, accepted, n_grams per document.

    Trained on the texts and their column lang, used for counting only. A document's host is
    that of its page's address if ``pages`` has one, else its source. Null texts, and those
    under four bytes, are "und" and not accepted; null lang, source or doc_id are allowed.
    One row per input row, repeated rows too; other columns are not looked at; an empty
    table gives an empty table.
    """
    model = train(docs.select("text", "lang"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("th"),
        "text",
        "source",
        F.lower(F.regexp_extract(F.coalesce("text", F.lit("")), MARKUP, 1)).alias("own"),
    )
    scored = likelihoods(rows, model, ["doc_id", "th", "source", "own"])
    if pages is None:
        met = scored.select("*", F.col("source").alias("host"), F.lit("").alias("suffix"), F.col("own").alias("declared"))
    else:
        met = (
            scored.join(addresses(pages).withColumnsRenamed({"host": "at", "declared": "markup"}), "doc_id", "left")
            .withColumn("host", F.coalesce(F.nullif("at", F.lit("")), "source"))
            .withColumn("declared", F.coalesce(F.nullif("markup", F.lit("")), "own"))
        )
    return fuse(met, model[0], ["doc_id", "th"])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages"))
    return out.select("doc_id", "language", F.round("probability", 6).alias("probability"), "accepted", "n_grams")
