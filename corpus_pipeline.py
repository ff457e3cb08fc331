"""A training corpus from documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import DOCUMENT_COLUMNS, read, small, staged
from branchlens.llm.decontam import contamination
from branchlens.llm.jaccard import linked_groups
from branchlens.llm.language import identify_documents
from branchlens.llm.line_dedup import dedup_lines
from branchlens.llm.sentencepieces import encode

NO_ID = -(1 << 63)
# Near copies of the stage: word shingles and percent. op5 has limits of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents other than those named by (doc_id, th), th being the hash of the text."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    names = gone.select(key.alias("_doc"), F.col("th").alias("_th")).distinct()
    rows = docs.select(*DOCUMENT_COLUMNS, key.alias("_doc"), F.xxhash64("text").alias("_th"))
    return rows.join(small(staged(names, "rejected")), ["_doc", "_th"], "left_anti").select(*DOCUMENT_COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; empty texts and text in none of the languages go."""
    found = identify_documents(docs, read(spark, sf_dir, "pages"))
    return _without(docs, found.where("not accepted"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a text of which nothing is left goes."""
    kept = dedup_lines(docs, keep=("lang", "source"))
    kept = kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, of equal ids that with the smallest hash.

    Near copies have at least 80 % of their five-word shingles in common (Jaccard similarity).
    A document is its id and its text: repeated rows are one document, an id with two texts is
    two. Documents without id stay only where no other of their group has one. Texts without words are
    in no group.
    """
    groups = linked_groups(docs, words=NEAR_WORDS, percent=NEAR_PERCENT, detail=True)
    keys = ["_nameless", "_doc", "_th"]
    name = [
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"),
        F.col("doc_id").isNull().alias("_nameless"),
        F.col("th").alias("_th"),
    ]
    documents = staged(groups.groupBy(*name, "root").agg(F.count("*").alias("_rows")), "near-groups")
    first = documents.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct(*keys, "_rows")).alias("_first")
    )
    stay = staged(
        first.select("_first.*").unionByName(
            documents.where(F.col("root").isNull()).select(*keys, "_rows")
        ),
        "kept-documents",
    )
    rows = docs.select(
        *DOCUMENT_COLUMNS,
        F.col("doc_id").isNull().alias("_nameless"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"),
        F.xxhash64("text").alias("_th"),
    )
    once, more = (stay.where(c).select(*keys) for c in ("_rows = 1", "_rows > 1"))
    single = rows.join(small(once), keys, "left_semi").select(*DOCUMENT_COLUMNS)
    # Repeated rows may differ in the other columns; the least of them stays, whatever the order of rows.
    repeated = rows.join(small(more), keys, "left_semi").groupBy(*keys).agg(
        F.min(F.struct(*DOCUMENT_COLUMNS)).alias("_row")
    )
    return single.union(repeated.select("_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("n_hit > 0"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, lossless: the piece ids of every text, checked by decoding."""
    out = encode(docs)
    return out.selectExpr("doc_id", "cast(size(ids) as long) as n_tokens", "ids", "lossless")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_dedup", jaccard_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokenization),
]

# Language identification and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
