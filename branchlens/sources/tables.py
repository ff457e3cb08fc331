"""Table writes on plain Parquet.

Partitioned writes carry a ``rebalance`` hint: adaptive execution then sizes the
files, splitting a hot partition over several tasks and joining small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.schemas import empty_table
from branchlens.sources.files import located, path_exists, write_text

_PULLS = "_pulls"


def require_partitioned(spark: SparkSession, path: str, partition_by: str) -> None:
    """Refuse a table that holds anything outside folders of ``partition_by``.

    Spark would ignore such files once partition folders lie beside them.
    """
    files, place = located(spark, path)
    if not files.exists(place):
        return
    for entry in files.listStatus(place):
        name = entry.getPath().getName()
        hidden = name.startswith(("_", ".")) and "=" not in name
        if not hidden and not (entry.isDirectory() and name.startswith(f"{partition_by}=")):
            raise ValueError(f"{path} is not partitioned by {partition_by}: it holds {name}")


def pull_is_done(spark: SparkSession, path: str, pull: str | None) -> bool:
    """Whether a named pull was merged into the table at ``path`` for good."""
    return pull is not None and path_exists(spark, f"{path}/{_PULLS}/{pull}")


def mark_pull(spark: SparkSession, path: str, pull: str | None) -> None:
    """Note beside the data, in a folder Spark does not read, that a pull is merged."""
    if pull is not None:
        write_text(spark, f"{path}/{_PULLS}/{pull}", "")


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Overwrite ``path`` with ``df`` and return the written table.

    Never point this at a path ``df`` itself reads from: the old files are
    deleted before the new ones are computed. See ``files.require_new_path``.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(
            partition_by
        ).parquet(path)
    return _read_as(df, path)


def append_table(df: DataFrame, path: str) -> DataFrame:
    """Add ``df`` to the table at ``path``; nothing is deduplicated."""
    df.write.mode("append").parquet(path)
    return _read_as(df, path)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> DataFrame:
    """Overwrite only the partitions that occur in ``df``."""
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )
    return _read_as(df, path)


def _read_as(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one of its schema when there is none yet."""
    if not path_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def day_shards(shards: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Rows of an inclusive day range; on a day-partitioned table only those days are read."""
    return shards.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
