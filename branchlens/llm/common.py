"""Helpers that several operators share: staged tables, hot keys, components, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Broadcast at most so many rows of a few numbers or short strings each.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 50_000_000
# At most so many keys count as hot: those with over one in HOT_KEYS of all rows.
HOT_KEYS = 1_000
BATCH = "8m"  # of Arrow data
_SALT, _HOT = "_salt", "_salts"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark for broadcast if the rows and their bytes as text, counted first, stay below the bounds."""
    size = F.lit(0).cast("long")
    for name in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    found, held = df.limit(rows + 1).agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if found <= rows and (held or 0) <= BROADCAST_BYTES else df


def join_hot(
    rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, total: int, how: str = "inner"
) -> DataFrame:
    """Join rows to one row per key that tells in column ``n`` how many rows have the key.

    A key with over total/HOT_KEYS rows is spread over ceil(rows/that) salts, and only
    its one row is repeated per salt. So there are at most HOT_KEYS hot keys (their list
    is broadcast) and at most 2 * HOT_KEYS repeated rows, at any size.
    """
    share = max(1, total // HOT_KEYS)
    salts = F.ceil(F.col(n) / F.lit(share)).cast("int")
    hot = per_key.where(F.col(n) > share).select(*keys, salts.alias(_HOT))
    spread = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.col(_HOT)).cast("int")
    left = rows.join(F.broadcast(hot), keys, "left").withColumn(
        _SALT, F.when(F.col(_HOT).isNull(), F.lit(0)).otherwise(spread)
    )
    copies = F.when(F.col(n) > share, F.sequence(F.lit(0), salts - 1)).otherwise(
        F.array(F.lit(0))
    )
    right = per_key.withColumn(_SALT, F.explode(copies))
    return left.drop(_HOT).join(right, [*keys, _SALT], how).drop(_SALT)


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, root): the smallest node reachable from each node of the links (a, b).

    Alternates large-star and small-star steps, each written to the shared folder, until
    the links stay as they are: about log(nodes) rounds. Nodes without links are absent.
    """
    now = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        name,
    )
    mark = None
    while True:
        total = now.count()
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(
            "u", F.least("m", "u").alias("m"), "n"
        )
        # Large star: all larger neighbours point to the least one.
        large = (
            join_hot(both, least, ["u"], "n", max(1, 2 * total))
            .where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: a node and its smaller neighbours point to the least one.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        own = low.select("u", F.col("m").alias("v"))
        others = (
            join_hot(large, low, ["u"], "n", max(1, total))
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = staged(own.union(others).distinct(), name)
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = seen


_kept: dict[str, tuple] = {}


def per_process(name: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gave for the last key; a Python worker keeps it for its next tasks."""
    if name not in _kept or _kept[name][0] != key:
        _kept[name] = (key, make())
    return _kept[name][1]


def forget() -> None:
    """Free what this Python worker kept, and give freed memory back to the system.

    Idle workers stay for a while, next to those of the following stage.
    """
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # elsewhere than on glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of some megabytes, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
