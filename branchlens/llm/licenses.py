"""Operator 9: licence scans by MinHash bands over overlapping text windows.

Method: texts are cut into windows of WINDOW words, STRIDE apart; templates into chunks of at
most CHUNK words. Any CHUNK words in a row lie inside one window. Each of BANDS bands is
the minimum of the window's shingle hashes, mixed anew for each band. A window and a chunk that share a
band make the document a candidate for the template; of the candidates alone the template's
shingles that stand anywhere in the text are counted exactly.

A chunk inside a window shares c of the window's 10 shingles, so one band misses it with probability
1 - c / 10 and all of them with (1 - c / 10) ** BANDS: 2e-4 for the three shingles of a notice of five
words, 6e-8 for the five of a full chunk. A template has a chance per chunk; a changed word costs
the chunks that hold it, so longer notices with changes are found by their other chunks. Only
DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import ascii_lower, read, small, staged

SHINGLE, WINDOW, STRIDE, CHUNK, BANDS = 3, 12, 6, 7, 24
NO_ID = -(1 << 63)
CONTAINED = 0.8  # share of a template's shingles that must stand in the text
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Licence notices as they are commonly written.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def words(text: Column) -> Column:
    """Hashes of the words of a text."""
    split = F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")
    return F.transform(split, lambda w: F.xxhash64(w))


def _shingle(w: Column, i: Column | int, size: Column) -> Column:
    """Hash of the three words from i on; a text of fewer words is one shingle."""
    at = F.lit(i) if isinstance(i, int) else i
    h = F.xxhash64(*(F.get(w, at + j) for j in range(SHINGLE)))
    return F.when((at + SHINGLE <= size) | ((at == 0) & (size > 0)), h)


def windows(rows: DataFrame, keep: list[str], stride: int, window: int) -> DataFrame:
    """keep, start, band, value: the bands of each window of the column words."""
    size = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(size - window + stride - 1, F.lit(0)), F.lit(stride))
    cut = rows.where(size > 0).select(*keep, "words", size.alias("size"), F.explode(starts).alias("start"))
    n = window - SHINGLE + 1
    hashes = cut.select(
        *keep, "start", *(_shingle(F.col("words"), F.col("start") + i, F.col("size")).alias(f"_h{i}") for i in range(n))
    )
    h = [F.col(f"_h{i}") for i in range(n)]
    masks = F.array(*(F.xxhash64(F.lit(f"band {b}")) for b in range(BANDS)))
    spread = hashes.select("*", F.posexplode(masks).alias("band", "mask"))
    # Mixing with a mask reorders the hashes; the least one is the band's minimum.
    least = F.least(*(F.when(x.isNotNull(), F.xxhash64(x, F.col("mask"))) for x in h))
    return spread.select(*keep, "start", "band", least.alias("value")).where(F.col("value").isNotNull())


def distinct_shingles(words: Column) -> Column:
    """The distinct shingles of a list of words, none of an empty one; as of ``_shingle``.

    The list is laid beside itself, since a lambda that indexes it would compute it anew for every word.
    """
    size = F.size(words)
    names = [f"w{j}" for j in range(SHINGLE)]
    shifted = [F.slice(words, F.lit(j + 1), size).alias(name) for j, name in enumerate(names)]
    every = F.transform(F.arrays_zip(*shifted), lambda x: F.xxhash64(*(x[name] for name in names)))
    return F.array_distinct(F.slice(every, F.lit(1), F.greatest(size - SHINGLE + 1, F.lit(1))))


def template_chunks(templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, value, template) of all chunks, and (template, license, shingles, total)."""
    rows = templates.select(
        F.xxhash64("license", "text").alias("template"), "license", words(F.col("text")).alias("words")
    ).where(F.size("words") > 0).dropDuplicates(["template"])
    size = F.size("words")
    starts = F.array_distinct(
        F.concat(
            F.filter(F.sequence(F.lit(0), size, F.lit(CHUNK - SHINGLE + 1)), lambda s: (s == 0) | (s + CHUNK <= size)),
            F.array(F.greatest(size - CHUNK, F.lit(0))),
        )
    )
    chunk = rows.select("template", F.explode(starts).alias("s"), "words").select(
        "template", F.slice("words", F.col("s") + 1, F.lit(CHUNK)).alias("words")
    )
    bands = windows(chunk, ["template"], CHUNK, CHUNK).select("template", "band", "value")
    whole = rows.select("template", "license", distinct_shingles(F.col("words")).alias("wanted"))
    return bands.distinct(), whole.withColumn("total", F.size("wanted"))


def candidates(docs: DataFrame, bands: DataFrame) -> DataFrame:
    """doc_id, th, template, start: documents that share a band with a template, and the first window that does."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), words(F.col("text")).alias("words")
    )
    return (
        windows(rows, ["doc_id", "th"], STRIDE, WINDOW)
        .join(small(bands), ["band", "value"])
        .groupBy("doc_id", "th", "template")
        .agg(F.min("start").alias("start"))
    )


def license_matches(docs: DataFrame, templates: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """doc_id, th, license, containment, start: licences whose template stands in a text.

    ``start`` is the first word of the first window that met it. doc_id null stays null.
    """
    bands, whole = template_chunks(templates)
    bands, whole = staged(bands, "license-bands"), staged(whole, "license-templates")
    met = staged(candidates(docs, bands).withColumn("_doc", F.coalesce("doc_id", F.lit(NO_ID))), "license-candidates")
    names = staged(met.select("_doc", "th").distinct(), "license-documents")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"), F.xxhash64("text").alias("th"), "text"
    ).join(small(names), ["_doc", "th"], "left_semi")
    wanted = whole.select("template", F.explode("wanted").alias("shingle"))
    # Shingles that no template has go first; a text and a template meet in at most so many as the template has.
    held = (
        texts.select("_doc", "th", F.explode(distinct_shingles(words(F.col("text")))).alias("shingle"))
        .join(small(wanted.select("shingle").distinct()), "shingle", "left_semi")
        .distinct()
        .join(small(wanted), "shingle")
        .groupBy("_doc", "th", "template")
        .agg(F.count("*").alias("n"))
    )
    found = (
        met.join(held, ["_doc", "th", "template"])
        .join(small(whole.select("template", "license", "total")), "template")
        .where(F.col("n") >= contained * F.col("total"))
    )
    return found.groupBy("doc_id", "th", "license").agg(
        F.max(F.col("n") / F.col("total")).alias("containment"), F.min("start").alias("start")
    )


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """license, text of whole licence files; a licence is named after its file."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[A-Za-z]+)?$", 1)
    return files.select(name.alias("license"), F.col("value").alias("text"))


def scan(docs: DataFrame, templates: DataFrame | None = None, contained: float = CONTAINED) -> DataFrame:
    """doc_id, n_licenses, licenses (sorted names), containment (largest) per document.

    Words are runs of a-z (A-Z lowered), 0-9 and characters beyond ASCII. A template is in a
    text if they share a band and at least ``contained`` of its distinct three-word shingles stand in the text,
    anywhere. ``templates`` has license and text, whole licences too (see ``read_templates``); null or empty texts match nothing. A null or
    empty document has no licence. One row per input row, repeated rows and null ids included;
    other columns are not looked at; empty tables give empty results.
    """
    if templates is None:
        templates = docs.sparkSession.createDataFrame(TEMPLATES, "license string, text string")
    per_text = (
        license_matches(docs, templates, contained)
        .groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"), F.col("th").alias("_th"))
        .agg(F.array_sort(F.collect_list("license")).alias("licenses"), F.max("containment").alias("containment"))
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_doc"),
        F.xxhash64("text").alias("_th"),
    )
    return rows.join(small(per_text), ["_doc", "_th"], "left").select(
        "doc_id",
        F.coalesce(F.size("licenses"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
