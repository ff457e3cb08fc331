"""Operator 8: drop lines that an earlier document already holds.

Method: the distinct line hashes are split into shards, and each shard gets a minimal
perfect hash (levels of collision-free bits) that maps them to 0..n-1. Three compact
arrays stand behind it: a fingerprint, the number of lines (0 if only one document has the
key) and the first document. Lines travel to their shard's arrays as (hash, document, line
number) and are looked up by position; no line is joined with another line or with a table
of lines. A line's hash has 64 bits and its fingerprint another 32.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import ascii_lower, forget, mix, read, shuffle_partitions, small_batches, staged

BLANK = " \t\n\x0b\x0c\r"
SHARD_KEYS = 200_000  # distinct lines per shard, about 4 MB of arrays
GAMMA = 1.5  # bits per key in a level of the hash
LEVELS = 48
NO_ID = (1 << 63) - 1  # rows without an id count as one last document
STATS = "shard int, h long, fp int, first long, n long"
INDEX = "shard int, sizes array<int>, bits binary, fps binary, counts binary, firsts binary, late binary"


def _slots(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def build_hash(h: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bit arrays over distinct 64-bit keys, and the keys that no level could place."""
    levels, rest = [], h
    while len(rest) and len(levels) < LEVELS:
        size = max(8, int(len(rest) * GAMMA))
        slot = _slots(rest, len(levels), size)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(alone)
        rest = rest[~alone[slot]]
    return levels, np.sort(rest)


class PerfectHash:
    """Position of each key among all keys, by the levels that ``build_hash`` made."""

    def __init__(self, levels: list[np.ndarray], late: np.ndarray):
        self.levels, self.late = levels, late
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits) - bits + before)
            before += int(bits.sum())
        self.placed = before

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """-1 where a key is surely not one of the hashed keys."""
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        for level, bits in enumerate(self.levels):
            if not len(left):
                return out
            slot = _slots(h[left], level, len(bits))
            hit = bits[slot]
            out[left[hit]] = self.ranks[level][slot[hit]]
            left = left[~hit]
        if len(self.late) and len(left):
            at = np.searchsorted(self.late, h[left])
            at = np.minimum(at, len(self.late) - 1)
            same = self.late[at] == h[left]
            out[left[same]] = self.placed + at[same]
        return out


def _build_shard(table: pa.Table) -> pa.Table:
    h = table["h"].to_numpy().astype(np.uint64)
    levels, late = build_hash(np.unique(h))
    at = PerfectHash(levels, late)(h)
    size = int(at.max()) + 1 if len(at) else 0
    fps, counts, firsts = np.zeros(size, np.int32), np.zeros(size, np.int64), np.zeros(size, np.int64)
    fps[at], counts[at], firsts[at] = table["fp"].to_numpy(), table["n"].to_numpy(), table["first"].to_numpy()
    return pa.table(
        {
            "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
            "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int32())),
            "bits": pa.array([b"".join(np.packbits(x).tobytes() for x in levels)], pa.binary()),
            "fps": pa.array([fps.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
            "firsts": pa.array([firsts.tobytes()], pa.binary()),
            "late": pa.array([late.tobytes()], pa.binary()),
        }
    )


class _Shard:
    def __init__(self, sizes: list[int], bits: bytes, fps: bytes, counts: bytes, firsts: bytes, late: bytes):
        levels, at = [], 0
        for size in sizes:
            part = np.frombuffer(bits, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(part, count=size).astype(bool))
            at += (size + 7) // 8
        self.place = PerfectHash(levels, np.frombuffer(late, np.uint64))
        self.fps, self.counts, self.firsts = (
            np.frombuffer(x, t) for x, t in ((fps, np.int32), (counts, np.int64), (firsts, np.int64))
        )

    def dropped(self, h: np.ndarray, fp: np.ndarray, doc: np.ndarray) -> np.ndarray:
        at = self.place(h.astype(np.uint64))
        safe = np.maximum(at, 0)
        return (at >= 0) & (self.fps[safe] == fp) & (self.counts[safe] > 0) & (self.firsts[safe] != doc)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its index row before its lines; gives the lines to drop."""
    index, of = None, None
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        h, fp, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "fp", "doc"))
        drop = np.zeros(len(kind), dtype=bool)
        edges = np.flatnonzero((kind[1:] != kind[:-1]) | (shard[1:] != shard[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(kind)], strict=True):
            if a == b:
                continue
            if kind[a] == 0:
                row = {c: batch.column(c)[int(a)].as_py() for c in ("sizes", "bits", "fps", "counts", "firsts", "late")}
                index, of = _Shard(**row), shard[a]
            elif of == shard[a]:
                drop[a:b] = index.dropped(h[a:b].astype(np.int64), fp[a:b].astype(np.int32), doc[a:b].astype(np.int64))
        keep = pa.array(drop)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(keep) for c in ("doc", "th", "line")], names=["doc", "th", "line"]
        )


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, drops = batch.column("text").to_pylist(), batch.column("_drops").to_pylist()
        out, n_lines, n_dropped = [], [], []
        for text, drop in zip(texts, drops, strict=True):
            lines = (text or "").split("\n")
            gone = set(drop or ())
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text or "")
        names = [x for x in batch.schema.names if x not in ("text", "_drops")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in names), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=[*names, "text", "n_lines", "n_dropped"],
        )
    forget()


def line_index(lines: DataFrame, total_shards: int) -> tuple[DataFrame, DataFrame]:
    """Per shard: the perfect hash and its arrays; and the statistics they are built from."""
    shard = F.pmod("h", F.lit(total_shards)).cast("int").alias("shard")
    n = F.when(F.min("doc") != F.max("doc"), F.count("*")).otherwise(0)
    stats = staged(
        lines.groupBy("h", "fp").agg(F.min("doc").alias("first"), n.alias("n"), F.count("*").alias("rows")).select(shard, "*"),
        "line-stats",
    )
    index = stats.select("shard", "h", "fp", "first", "n").groupBy("shard").applyInArrow(_build_shard, INDEX)
    return staged(index, "line-index"), stats


def dedup_lines(docs: DataFrame, min_chars: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep``, text without its repeated lines, n_lines, n_dropped.

    Of lines with equal keys (blanks at the ends removed, A-Z lowered) of at least
    ``min_chars`` code points found in two or more documents, only those in the document
    with the smallest id stay. A null or empty text is one empty line. Rows without an id
    count as one document after all others; rows that share an id are one document, and an
    exact repetition of a row is treated like the row. Other columns of the input, whatever
    their names, are not looked at. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = shuffle_partitions(spark)
    base = docs.select("doc_id", *keep, "text").select(
        "*", F.coalesce("doc_id", F.lit(NO_ID)).alias("_doc"), F.xxhash64("text").alias("_th")
    )
    key = F.btrim(ascii_lower(F.col("line_text")), F.lit(BLANK))
    lines = (
        base.select(
            F.col("_doc").alias("doc"),
            F.col("_th").alias("th"),
            F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "line_text"),
        )
        .select("doc", "th", "line", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc", "th", "line", F.xxhash64("key").alias("h"), F.hash("key").alias("fp"))
    )
    lines = staged(lines, "line-hashes")
    # Enough shards for every task, and few enough keys in each for its memory.
    about = lines.agg(F.approx_count_distinct("h"), F.count("*")).first()
    shards = max(4 * parts, -(-about[0] // SHARD_KEYS))
    index, stats = line_index(lines, shards)
    # A shard with more than its share of lines is read by several tasks.
    share = max(1, about[1] // (4 * parts))
    salts = F.ceil(F.sum("rows") / F.lit(share)).cast("int")
    hot = stats.groupBy("shard").agg(salts.alias("salts")).where("salts > 1")  # at most 4 * parts rows
    hot = F.broadcast(hot)
    blobs = index.join(hot, "shard", "left").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"),
        F.lit(0).alias("kind"),
        *(F.lit(0).cast(t).alias(c) for c, t in (("h", "long"), ("fp", "int"), ("doc", "long"), ("th", "long"), ("line", "int"))),
        "sizes", "bits", "fps", "counts", "firsts", "late",
    )
    probes = (
        lines.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
        .join(hot, "shard", "left")
        .select(
            "shard",
            F.pmod(F.xxhash64("doc", "th", "line"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"),
            F.lit(1).alias("kind"),
            "h", "fp", "doc", "th", "line",
            F.lit(None).cast("array<int>").alias("sizes"),
            *(F.lit(None).cast("binary").alias(c) for c in ("bits", "fps", "counts", "firsts", "late")),
        )
    )
    drops = (
        blobs.union(probes)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_probe, "doc long, th long, line int")
        .groupBy(F.col("doc").alias("_doc"), F.col("th").alias("_th"))
        .agg(F.collect_set("line").alias("_drops"))
    )
    marked = base.join(drops, ["_doc", "_th"], "left").drop("_doc", "_th")
    kinds = dict(marked.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in marked.columns if c not in ("text", "_drops"))
    return marked.mapInArrow(_rebuild, f"{schema}, text string, n_lines long, n_dropped long")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_key AS key FROM (
    SELECT doc_id, i, line,
           regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS lower_key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))
), held AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.i, l.line, (h.first IS NOT NULL AND h.first <> l.doc_id) AS gone
  FROM lines l LEFT JOIN held h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
