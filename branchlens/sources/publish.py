"""Merging a batch into a partitioned table, published against the table's version.

A batch is merged and staged first, together with the number of the table's last publish. To publish it,
its run claims the next number in ``_versions`` beside the data; a claim names the staged folder. If the
table has had another publish since, the batch is merged anew. Whoever finds a claim that was not
carried through publishes its staged rows before anything else, so a run that dies
while publishing is finished by the next one, and its repetition finds its work done.

Plain Parquet cannot swap partitions at once: one writer at a time, no readers while it publishes.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.schemas import empty_table
from branchlens.sources import key_index
from branchlens.sources.files import drop_staged, folder_names, located, path_exists, read_text, write_text
from branchlens.sources.tables import read_or_empty, replace_partitions, replace_table, require_partitioned

Merge = Callable[[DataFrame, DataFrame], DataFrame]
_VERSIONS, _DONE = "_versions", ".done"
_ROWS, _KEYS, _ABOUT, _PUBLISHED = "rows", "keys", "about.json", "published"


def _claims(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in folder_names(spark, f"{path}/{_VERSIONS}") if n.isdecimal()]


def table_version(spark: SparkSession, path: str) -> int:
    """Number of the table's last publish, 0 before the first."""
    return max(_claims(spark, path), default=0)


def _claim_path(path: str, number: int) -> str:
    return f"{path}/{_VERSIONS}/{number:012d}"


def unfinished_publish(spark: SparkSession, path: str) -> str | None:
    """Staged folder of a publish that was claimed and not carried through."""
    number = table_version(spark, path)
    claim = _claim_path(path, number)
    if number == 0 or path_exists(spark, claim + _DONE):
        return None
    staged = read_text(spark, claim)
    if staged:
        return staged
    drop_staged(spark, claim)  # died before its name was written; nothing was published
    return unfinished_publish(spark, path)


def claim_publish(spark: SparkSession, path: str, staged: str) -> bool:
    """Claim the publish after the one the staged rows were merged with; False if that is taken."""
    about = _about(spark, staged)
    if about is None or about["version"] != table_version(spark, path):
        return False
    return write_text(spark, _claim_path(path, about["version"] + 1), staged, replace=False)


def _about(spark: SparkSession, staged: str) -> dict | None:
    text = read_text(spark, f"{staged}/{_ABOUT}")
    return json.loads(text) if text else None


def _in_partitions(target: DataFrame, partitions: set, partition_by: str) -> DataFrame:
    """Target rows in the listed partitions; the others are not even opened."""
    column = F.col(partition_by)
    wanted = column.isin([p for p in partitions if p is not None])
    return target.where((wanted | column.isNull()) if None in partitions else wanted)


def stage_merge(
    spark: SparkSession, path: str, source: DataFrame, key: str, partition_by: str, merge: Merge, staged: str,
    replaces: bool = False,
) -> None:
    """Merge a batch with the partitions it touches, and stage the rows to publish.

    Touched are the batch's own partitions and those its keys are in now, which the key
    index tells. One value per touched partition comes to the driver. ``replaces`` states that after the
    merge the rows of the batch's keys are those of the batch, so the batch tells where its keys are.
    """
    drop_staged(spark, staged)
    version = table_version(spark, path)
    there = path_exists(spark, path) and any("=" in n for n in folder_names(spark, path))
    target = read_or_empty(spark, path, source.schema) if there else empty_table(spark, source.schema)
    own, ranges = key_index.batch_ranges(source, key, partition_by)
    now = set()
    if there and ranges:
        if not key_index.is_indexed(spark, path):
            key_index.build_index(target, path, version, key, partition_by)
        found = key_index.partitions_of_keys(spark, path, source, ranges, key, partition_by)
        now = {r[0] for r in found.collect()}
    touched = _in_partitions(target, own | now, partition_by)
    rows = replace_table(merge(touched, source).select(*source.columns), f"{staged}/{_ROWS}")
    placed = (source if replaces else rows).where(F.col(key).isNotNull()).select(key, partition_by)
    if there and not replaces:  # in a new table all rows are the batch's
        keys = source.where(F.col(key).isNotNull()).select(key).distinct()
        placed = placed.join(keys, key, "left_semi")
    replace_table(placed.distinct(), f"{staged}/{_KEYS}")
    about = {
        "version": version, "key": key, "partition_by": partition_by,
        # Only partitions that keys may have left can have lost all their rows.
        "left": [None if p is None else str(p) for p in now - own],
    }
    write_text(spark, f"{staged}/{_ABOUT}", json.dumps(about))


def _drop_partition(spark: SparkSession, path: str, partition_by: str, value: str | None) -> None:
    """Delete the folder of one partition; Spark's own naming gives its path."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    drop_staged(spark, f"{path}/{names.getPartitionPathString(partition_by, value)}")


def finish_publish(spark: SparkSession, path: str) -> None:
    """Carry a claimed publish through; does nothing when there is none.

    Every step may be repeated: no other publish starts before this one is done.
    """
    staged = unfinished_publish(spark, path)
    if staged is None:
        return
    about = _about(spark, staged)
    if about is None:
        raise RuntimeError(f"the staged rows of an unfinished publish of {path} are gone: {staged}")
    key, partition_by, number = about["key"], about["partition_by"], about["version"] + 1
    rows = spark.read.parquet(f"{staged}/{_ROWS}")
    replace_partitions(rows, path, partition_by)
    if about["left"]:
        text = F.col(partition_by).cast("string")
        kept = {r[0] for r in rows.select(text).distinct().collect()}
        for value in about["left"]:
            if value not in kept:
                _drop_partition(spark, path, partition_by, value)
    key_index.add_entries(spark.read.parquet(f"{staged}/{_KEYS}"), path, number, key, partition_by)
    write_text(spark, f"{staged}/{_PUBLISHED}", "")
    write_text(spark, _claim_path(path, number) + _DONE, "")
    for old in _claims(spark, path):
        if old < number:
            drop_staged(spark, _claim_path(path, old) + _DONE)
            drop_staged(spark, _claim_path(path, old))


def release_staged(spark: SparkSession, path: str, staged: str) -> None:
    """Delete staged rows, unless a publish still needs them."""
    pending = unfinished_publish(spark, path)
    if pending is None or not located(spark, pending)[1].equals(located(spark, staged)[1]):
        drop_staged(spark, staged)


def refresh_partitions(
    spark: SparkSession,
    target_path: str,
    source: DataFrame,
    key: str,
    partition_by: str,
    merge: Merge,
    staged_path: str,
    replaces: bool = False,
) -> None:
    """Merge a batch into a partitioned table, rewriting only touched partitions.

    A key may move to another partition: the partition it leaves is rewritten too, and
    deleted when nothing is left in it. Repeating a run with the same ``staged_path``
    changes nothing once its rows are published; before that, staged rows are used if
    the table is still as it was, else the batch is merged anew.
    """
    require_partitioned(spark, target_path, partition_by)
    while True:
        finish_publish(spark, target_path)
        if path_exists(spark, f"{staged_path}/{_PUBLISHED}"):
            return
        about = _about(spark, staged_path)
        if about is None or about["version"] != table_version(spark, target_path):
            stage_merge(spark, target_path, source, key, partition_by, merge, staged_path, replaces)
        claim_publish(spark, target_path, staged_path)
