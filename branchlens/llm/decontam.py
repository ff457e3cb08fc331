"""Operator 3: benchmark passages in training documents, by a positional inverted index.

Method: every training token that some benchmark item uses is stored as a posting (term,
row, position). A window of benchmark words is looked up from its rarest term: that term's
postings, shifted by its offset, give the places where the window may start; these lists are
intersected with the shifted postings of the second rarest term, then of all others. Only
DataFrame operations are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchlens.llm.common import ascii_lower, read, small, staged

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
END, END_TERM, ENDS = "\u0000", -1, 1024  # closes each document's words; cannot be a word itself


@dataclass(frozen=True)
class PositionalIndex:
    postings: DataFrame  # row, pos, term: tokens that some item uses
    documents: DataFrame  # row, doc_id, th (hash of the text), n_words: every document
    windows: DataFrame  # wid, size, off, term, rank: rank 1 is the rarest term
    items: DataFrame  # wid, item: the items that hold a window


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """wid, words, item: each run of ``window`` words, or all words of a shorter item."""
    split = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        words(F.col("text")).alias("all"),
    ).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    runs = split.select("item", "all", F.explode(starts).alias("at"))
    run = F.slice("all", F.col("at"), F.lit(window))
    return runs.select("item", run.alias("words")).select(
        F.xxhash64("words").alias("wid"), "words", "item"
    ).distinct()


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> PositionalIndex:
    """Postings of all tokens of ``docs`` that occur in ``benchmark``, written once."""
    runs = staged(item_windows(benchmark, window), "windows")
    terms = runs.select(F.explode("words").alias("word")).distinct()
    numbered = F.row_number().over(Window.partitionBy("part").orderBy("word"))
    vocabulary = staged(
        # Numbered within 256 parts: term = number * 256 + part.
        terms.withColumn("part", F.pmod(F.hash("word"), F.lit(256)))
        .select("word", (numbered * 256 + F.col("part")).cast("int").alias("term"))
        .union(docs.sparkSession.createDataFrame([(f"{END}{i}", END_TERM) for i in range(ENDS)], "word string, term int")),
        "vocabulary",
    )
    # Every document has an end; ends are of many kinds, so that no join sees them as one key.
    end = F.concat(F.lit(END), F.pmod(F.col("row"), F.lit(ENDS)).cast("string"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("words")
    ).withColumn("words", F.concat("words", F.array(end)))
    tokens = rows.select("row", "doc_id", "th", F.posexplode("words").alias("pos", "word"))
    is_end = F.col("term") == END_TERM
    index = staged(
        tokens.join(small(vocabulary), "word").select(
            "row",
            F.when(is_end, F.col("doc_id")).alias("doc_id"),
            F.when(is_end, F.col("th")).alias("th"),
            "pos",
            "term",
        ),
        "postings",
    )
    postings = index.where(F.col("term") != END_TERM).select("row", "pos", "term")
    documents = index.where(is_end).select("row", "doc_id", "th", F.col("pos").alias("n_words"))
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    placed = (
        runs.select("wid", "words")
        .distinct()
        .select("wid", F.size("words").alias("size"), F.posexplode("words").alias("off", "word"))
        .join(small(vocabulary), "word")
        .join(counts, "term", "left")
    )
    rarest = Window.partitionBy("wid").orderBy("n", "off")  # at most ``window`` rows each
    known = F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("wid"))
    windows = (
        placed.withColumn("rank", F.row_number().over(rarest))
        .withColumn("least", known)
        .where("least > 0")  # a window with an unseen term occurs nowhere
        .select("wid", "size", "off", "term", "rank")
    )
    return PositionalIndex(
        postings, documents, staged(windows, "window-terms"), runs.select("wid", "item").distinct()
    )


def _starts(index: PositionalIndex) -> DataFrame:
    """row, wid, start: postings of each window's rarest term, shifted by its offset."""
    anchor = index.windows.where("rank = 1").select("wid", "term", "size", F.col("off").alias("o"))
    return (
        index.postings.join(small(anchor), "term")
        .select("row", "wid", "size", (F.col("pos") - F.col("o")).alias("start"))
        .where("start >= 0")
    )


def exact_matches(index: PositionalIndex) -> DataFrame:
    """row, wid, size, start: every place where all words of a window stand in order."""
    starts = _starts(index)
    second = index.windows.where("rank = 2").select("wid", "term", F.col("off").alias("o"))
    seconds = index.postings.join(small(second.select("term").distinct()), "term", "left_semi")
    paired = (
        starts.join(small(second), "wid", "left")
        .withColumn("pos", F.col("start") + F.col("o"))
        .join(seconds.withColumn("found", F.lit(1)), ["row", "pos", "term"], "left")
        .where("o is null or found = 1")
        .select("row", "wid", "size", "start")
    )
    paired = staged(paired, "starts")
    # All further terms at once, on the documents that are left.
    rest = index.windows.where("rank > 2").select("wid", "term", F.col("off").alias("o"))
    wanted = paired.join(small(rest), "wid").select(
        "row", "wid", "size", "start", "term", (F.col("start") + F.col("o")).alias("pos")
    )
    rows = small(paired.select("row").distinct())
    near = index.postings.join(rows, "row", "left_semi")
    whole = (
        wanted.join(near, ["row", "pos", "term"])
        .groupBy("row", "wid", "size", "start")
        .agg(F.count("*").alias("n"))
        .where("n = size - 2")
        .drop("n")
    )
    return whole.union(paired.where("size <= 2").select(*whole.columns))


def proximity_matches(index: PositionalIndex, span: int = 2 * WINDOW) -> DataFrame:
    """row, wid, pos: the rarest term of a window with all its other terms at most ``span`` words away.

    Order and repetition do not matter. Positions are cut into blocks of ``span`` words, and of
    each term only its first and last place in a block count: so a place meets at most three
    rows per term, whatever the length of the document. Places without the second rarest term
    nearby go first, the others are joined to their window's further terms.
    """
    distinct = index.windows.groupBy("wid", "term").agg(F.min("rank").alias("first"))
    order = Window.partitionBy("wid").orderBy("first")  # at most ``window`` rows each
    terms = staged(distinct.select("wid", "term", F.row_number().over(order).alias("nth")), "near-terms")
    size = terms.groupBy("wid").agg(F.count("*").alias("terms"))
    blocks = index.postings.groupBy("row", F.floor(F.col("pos") / span).alias("block"), "term").agg(
        F.min("pos").alias("low"), F.max("pos").alias("high")
    )

    def nearby(places: DataFrame, wanted: DataFrame, postings: DataFrame) -> DataFrame:
        """row, wid, pos, found: places and how many of the wanted terms of their window are near."""
        around = F.array(*(F.floor(F.col("pos") / span) + i for i in (-1, 0, 1)))
        return (
            places.join(small(wanted), "wid")
            .withColumn("block", F.explode(around))
            .join(postings, ["row", "block", "term"])
            .where((F.col("high") >= F.col("pos") - span) & (F.col("low") <= F.col("pos") + span))
            .groupBy("row", "wid", "pos")
            .agg(F.count_distinct("term").alias("found"))
        )

    anchor = terms.where("nth = 1").join(size, "wid").select("wid", "term", "terms")
    places = index.postings.join(small(anchor), "term").select("row", "wid", "pos", "terms")
    second = terms.where("nth = 2").select("wid", "term")
    seconds = blocks.join(small(second.select("term").distinct()), "term", "left_semi")
    paired = nearby(places.where("terms > 1").drop("terms"), second, seconds).drop("found")
    paired = staged(paired, "near-places")
    rest = terms.where("nth > 2").select("wid", "term")
    left = blocks.join(small(paired.select("row").distinct()), "row", "left_semi")
    whole = nearby(paired, rest, left).join(small(size), "wid").where("found = terms - 2")
    few = paired.join(small(size.where("terms = 2")), "wid", "left_semi")
    alone = places.where("terms = 1")
    return whole.select("row", "wid", "pos").union(few.select("row", "wid", "pos")).union(alone.select("row", "wid", "pos"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, th, n_words, n_hit, n_items, items (sorted texts of the ids).

    Words are runs of a-z (A-Z lowered), 0-9 and characters beyond ASCII. An item's windows
    are its runs of ``window`` words; a shorter item is one window; an item without words,
    null text included, has none. A word inside an occurrence of a window is hit. A null or
    empty text has no words. Each input row gives one row, repeated rows too; an item that
    stands in several rows counts once; a null item id reads "null". Other columns of the
    input are not looked at. An empty benchmark hits nothing, an empty table gives one.
    """
    index = build_index(docs, benchmark, window)
    found = staged(exact_matches(index), "matches")
    hit = (
        found.select("row", "start", "size").distinct()
        .select("row", F.explode(F.expr("sequence(start, start + size - 1)")).alias("pos"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        found.select("row", "wid").distinct()
        .join(small(index.items), "wid")
        .select("row", "item").distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    return (
        index.documents.join(hit, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "th",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def proximity(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_near, n_near_items: benchmark passages with their words in any order.

    ``n_near`` counts the places of ``proximity_matches``, a place of several windows once;
    n_near_items the items whose windows they are. Rows, words and windows as in ``contamination``.
    """
    index = build_index(docs, benchmark, window)
    found = staged(proximity_matches(index, 2 * window), "near-matches")
    places = found.select("row", "pos").distinct().groupBy("row").agg(F.count("*").alias("n_near"))
    items = (
        found.select("row", "wid").distinct()
        .join(small(index.items), "wid")
        .select("row", "item").distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_near_items"))
    )
    return index.documents.join(places, "row", "left").join(items, "row", "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
    )


def op3_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(g) AS n FROM win),
grams AS (
  SELECT doc_id, i, list_slice(w, i, i + n - 1) AS g, n
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN win USING (g)),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
