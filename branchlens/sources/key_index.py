"""Where keys are: an index beside a table, so that a merge need not read the table to find them.

Each publish adds a folder ``_keys/publish=<n>`` of (key, partition) rows in the order of the
key, in small row groups. A look-up pushes the key ranges of its batch down to them, so row groups
outside these are skipped; keys that rise with time then cost about as much as the batch. Of a
key, the entries of its last publish count. From ``DELTAS`` folders on, the next publish writes the
whole index anew; ``_keys/_base`` names the first folder that counts.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from branchlens.sources.files import drop_staged, folder_names, is_complete, read_text, write_text

DELTAS = 16
ROW_GROUP = 4 << 20  # bytes
RANGES = 64  # of keys, that a look-up pushes down
_FOLDER, _NUMBER, _BASE, _RANK = "_keys", "publish", "_base", "_rank"


def _folder(path: str, number: int) -> str:
    return f"{path}/{_FOLDER}/{_NUMBER}={number}"


def _numbers(spark: SparkSession, path: str, below: int | None = None) -> list[int]:
    """Publishes in the index that count, those before ``below``."""
    base = int(read_text(spark, f"{path}/{_FOLDER}/{_BASE}") or 0)
    names = [n for n in folder_names(spark, f"{path}/{_FOLDER}") if n.startswith(f"{_NUMBER}=")]
    numbers = [int(n.partition("=")[2]) for n in names]
    return [
        n for n in sorted(numbers)
        if n >= base and (below is None or n < below) and is_complete(spark, _folder(path, n))
    ]


def is_indexed(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _write(entries: DataFrame, path: str, number: int, key: str) -> None:
    ordered = entries.repartitionByRange(key).sortWithinPartitions(key)
    ordered.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(_folder(path, number))


def _entries(spark: SparkSession, path: str, numbers: list[int], like: DataFrame, key: str, partition_by: str) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in like.schema.fields}
    schema = f"`{key}` {types[key]}, `{partition_by}` {types[partition_by]}, {_NUMBER} long"
    reader = spark.read.schema(schema).option("basePath", f"{path}/{_FOLDER}")
    return reader.parquet(*[_folder(path, n) for n in numbers])


def _newest(entries: DataFrame, key: str, partition_by: str) -> DataFrame:
    """Of each key the entries of its last publish.

    A key has few entries, one or some per publish; they are ranked in one pass over all.
    """
    latest = Window.partitionBy(key).orderBy(F.desc(_NUMBER))
    kept = entries.withColumn(_RANK, F.rank().over(latest)).where(F.col(_RANK) == 1)
    return kept.select(key, partition_by).distinct()


def batch_ranges(source: DataFrame, key: str, partition_by: str) -> tuple[set, list[tuple]]:
    """A batch's partitions, and the ranges its keys lie in, at most ``RANGES`` of them.

    One row per partition of the batch comes to the driver. Keys often follow time, hence one
    range per partition; overlapping ones are joined, then those that lie next to each other.
    """
    found = source.groupBy(partition_by).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    joined: list[list] = []
    for low, high in sorted((r.low, r.high) for r in found if r.low is not None):
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    while len(joined) > RANGES:
        joined = [[a[0], (b or a)[1]] for a, b in zip(joined[::2], joined[1::2] + [None], strict=False)]
    return {r[0] for r in found}, [tuple(r) for r in joined]


def _in_ranges(key: str, ranges: list[tuple]) -> Column:
    return reduce(operator.or_, [F.col(key).between(F.lit(low), F.lit(high)) for low, high in ranges])


def partitions_of_keys(
    spark: SparkSession, path: str, source: DataFrame, ranges: list[tuple], key: str, partition_by: str
) -> DataFrame:
    """Partitions that hold keys of the batch now, as one column."""
    numbers = _numbers(spark, path)
    entries = _entries(spark, path, numbers, source, key, partition_by).where(_in_ranges(key, ranges))
    wanted = source.where(F.col(key).isNotNull()).select(key).distinct()
    found = entries.join(wanted, key, "left_semi")
    if len(numbers) > 1:
        found = _newest(found, key, partition_by)
    return found.select(partition_by).distinct()


def build_index(target: DataFrame, path: str, number: int, key: str, partition_by: str) -> None:
    """Index a table that has none; reads its key and partition columns once."""
    found = target.where(F.col(key).isNotNull()).select(key, partition_by).distinct()
    _write(found, path, number, key)


def add_entries(entries: DataFrame, path: str, number: int, key: str, partition_by: str) -> None:
    """Add a publish's (key, partition) rows; doing so again replaces them."""
    spark = entries.sparkSession
    before = _numbers(spark, path, below=number)
    if len(before) < DELTAS:
        _write(entries, path, number, key)
        return
    older = _entries(spark, path, before, entries, key, partition_by)
    both = older.unionByName(entries.select(key, partition_by).withColumn(_NUMBER, F.lit(number).cast("long")))
    _write(_newest(both, key, partition_by), path, number, key)
    write_text(spark, f"{path}/{_FOLDER}/{_BASE}", str(number))
    for old in before:
        drop_staged(spark, _folder(path, old))
