"""Landing JSON -> fixed schema -> staging -> merge, and the back-fill of old shards."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens import schemas
from branchlens.functions import clock
from branchlens.functions.nested import (
    array_int_or_empty,
    array_struct_or_empty,
    array_to_json_strings,
    empty_array,
    flatten_structs,
    lift_nested,
)
from branchlens.operators.merge import first_day_rows, insert_only, insert_only_by_day, upsert
from branchlens.session import fresh_path
from branchlens.sources.files import drop_staged, folder_names, path_exists, require_new_path
from branchlens.sources.landing import Quarantine, pull_folder, read_envelopes
from branchlens.sources.publish import refresh_partitions, release_staged
from branchlens.sources.tables import (
    day_shards,
    read_or_empty,
    replace_partitions,
    replace_table,
    require_partitioned,
)

# When a record came to be; its UTC day is the partition it lies in. Shards
# lie under the local day instead and are placed anew by the back-fill.
MOMENT = {"receipts": "created_at", "shifts": "opened_at"}
# What tells the later of two copies of a record: an open shift has no closing time.
UPDATED = {"receipts": "updated_at", "shifts": "closed_at"}
DAY = "ds"
FOOTERS = 8  # days whose footers are read at once


def window_filter(records: DataFrame, window: tuple[datetime, datetime], column: str) -> DataFrame:
    """Records created within an ingest window, both ends included."""
    return records.where(clock.in_window(records, column, window))


def landed_records(
    spark: SparkSession,
    path: str,
    key: str,
    schema: T.StructType,
    record: T.StructType | None = None,
    quarantine: Quarantine | None = None,
    load: str = "all",
) -> DataFrame:
    """Landed records flattened and projected onto a fixed schema.

    ``record`` describes the raw records where they nest differently. Without
    it, a column may be nested in any way its name allows.
    """
    raw = read_envelopes(
        spark, path, key, record or schemas.record_schema(schema), quarantine, load
    )
    return conformed_records(raw, schema)


def conformed_records(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return schemas.conform(lift_nested(flatten_structs(raw), schema.fieldNames()), schema)


def stage(
    spark: SparkSession,
    entity: str,
    landing: str,
    staging: str,
    window: tuple[datetime, datetime] | None = None,
    pull: str | None = None,
    quarantine: Quarantine | None = None,
) -> tuple[DataFrame, int]:
    """Replace the staging table of ``entity`` by its landed records; also their number.

    Only the pages of ``pull`` are read, when it is named. The rows are counted
    while they are written. Broken lines go to ``quarantine`` if there is one.
    """
    schema = schemas.SCHEMAS[entity]
    records = landed_records(
        spark, pull_folder(landing, pull), entity, schema,
        quarantine=quarantine, load=pull or "all",
    )
    if window is not None:
        records = window_filter(records, window, MOMENT[entity])
    loaded = Observation()
    staged = replace_table(records.observe(loaded, F.count(F.lit(1)).alias("rows")), staging)
    return staged, loaded.get["rows"]


def stage_shards(
    spark: SparkSession,
    landing: str,
    path: str,
    window: tuple[datetime, datetime] | None = None,
    tz: str = clock.LOCAL_TZ,
    pull: str | None = None,
) -> DataFrame:
    """Older shift staging: one partition per local day, replaced as a whole.

    Only the days of the landed records are overwritten. Here ``taxes`` are
    numbers, and ``cash_movements`` count only if all of them are objects.
    """
    record = schemas.record_schema(schemas.SHIFTS)
    pages = read_envelopes(spark, pull_folder(landing, pull), "shifts", record)
    raw = lift_nested(flatten_structs(pages), schemas.SHIFTS.fieldNames())
    repaired = raw.withColumns(
        {
            "taxes": array_int_or_empty(F.col("taxes"), raw.schema["taxes"].dataType),
            "cash_movements": array_struct_or_empty(
                F.col("cash_movements"), raw.schema["cash_movements"].dataType
            ),
        }
    )
    moment = MOMENT["shifts"]
    records = schemas.conform(repaired, schemas.SHIFTS_SHARD)
    if window is not None:
        records = window_filter(records, window, moment)
    by_day = records.withColumn(DAY, F.to_date(clock.to_local(F.col(moment), tz)))
    return replace_partitions(by_day, path, DAY)


def merge_of(
    entity: str, mode: str = "upsert", on_duplicate: str = "error"
) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The merge of an entity as a function of its table and a batch."""
    key = schemas.MERGE_KEYS[entity]

    def merged(target: DataFrame, source: DataFrame) -> DataFrame:
        if mode == "insert":
            return insert_only(target, source, key)
        return upsert(target, source, key, on_duplicate, UPDATED[entity])

    return merged


def merge_days(
    spark: SparkSession,
    entity: str,
    staged: DataFrame,
    target_path: str,
    mode: str = "upsert",
    on_duplicate: str = "error",
    work_path: str | None = None,
) -> None:
    """Merge a staged batch into a day-partitioned table, creating it if absent.

    Keys match wherever they are: the days in the batch and those that hold its
    keys are rewritten, of the others only key and day are read. ``mode="insert"``
    leaves existing rows alone. A caller that may repeat the batch names a
    ``work_path`` and drops it when the batch is done for good.
    """
    staging = work_path or fresh_path(spark, f"{entity}_merged")
    try:
        refresh_partitions(
            spark,
            target_path,
            with_day(staged, entity),
            schemas.MERGE_KEYS[entity],
            DAY,
            merge_of(entity, mode, on_duplicate),
            staging,
            replaces=mode == "upsert" and on_duplicate == "error",
        )
    finally:
        if work_path is None:
            release_staged(spark, target_path, staging)


def with_day(records: DataFrame, entity: str) -> DataFrame:
    """Records with the day partition they belong to."""
    return records.withColumn(DAY, F.to_date(MOMENT[entity]))


def merge_table(
    spark: SparkSession,
    entity: str,
    staged: DataFrame,
    current: str,
    target: str,
    mode: str = "upsert",
    on_duplicate: str = "error",
) -> DataFrame:
    """Merge a staged batch into the table at ``current``, written whole to ``target``.

    For tables without day partitions. The target is a new path, since Parquet
    cannot be overwritten while it is read.
    """
    require_new_path(spark, current, target)
    rows = read_or_empty(spark, current, schemas.SCHEMAS[entity])
    return replace_table(merge_of(entity, mode, on_duplicate)(rows, staged), target)


def read_days(
    spark: SparkSession, entity: str, path: str, since: datetime | None = None
) -> DataFrame:
    """The day-partitioned table of ``entity``, without its partition column.

    With ``since``, earlier days are not even listed; records of that first day
    before the moment itself remain.
    """
    schema = schemas.SCHEMAS[entity]
    require_partitioned(spark, path, DAY)
    stored = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    table = read_or_empty(spark, path, stored)
    if since is not None:
        table = table.where(F.col(DAY) >= F.lit(clock.as_utc(since).date()))
    return table.select(*schema.fieldNames())


# --- back-fill of daily shards --------------------------------------------


def _as_json_strings(df: DataFrame, name: str) -> Column:
    """The list as JSON texts; stored lists of text are JSON documents already."""
    dtype = df.schema[name].dataType
    if dtype == T.ArrayType(T.StringType()):
        return F.coalesce(F.col(name), empty_array("string"))
    return array_to_json_strings(F.col(name), dtype)


def shard_frames(
    spark: SparkSession, path: str, day: str, first: str, last: str
) -> list[DataFrame]:
    """The shards of an inclusive day range, one frame per schema that their files have.

    Each day was written with types of its own: a list may hold numbers on one day, objects or
    texts on another, and one read takes one schema. The footers of every day are read
    first; days alike are then read together. Days outside the range are not opened.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    days = {}
    for name in folder_names(spark, path):
        column, _, value = name.partition("=")
        if column == day and value[:1].isdigit() and first <= value <= last:
            days[value] = f"{path}/{name}"

    def schema(folder: str) -> T.StructType:
        return spark.read.option("mergeSchema", True).parquet(folder).schema

    with ThreadPoolExecutor(FOOTERS) as pool:
        schemas_of = list(pool.map(schema, days.values()))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder, found in zip(days.values(), schemas_of, strict=True):
        groups.setdefault(found.simpleString(), (found, []))[1].append(folder)
    return [
        spark.read.schema(T.StructType([*found.fields, T.StructField(day, T.DateType())]))
        .option("basePath", path)
        .parquet(*folders)
        for found, folders in groups.values()
    ]


def shard_union(
    spark: SparkSession, path: str, day: str, first: str, last: str, schema: T.StructType
) -> DataFrame:
    """The shards of a day range as rows of ``schema`` and their day, lists as JSON texts."""
    out = schemas.empty_table(spark, T.StructType([*schema.fields, T.StructField(day, T.DateType())]))
    for shards in shard_frames(spark, path, day, first, last):
        lists = [f.name for f in schema.fields if f.dataType == T.ArrayType(T.StringType())]
        texts = normalise_shards(shards, tuple(c for c in lists if c in shards.columns))
        out = out.unionByName(schemas.conform(texts, out.schema))
    return out


def normalise_shards(
    shards: DataFrame, arrays: tuple[str, ...] = ("cash_movements", "taxes")
) -> DataFrame:
    """The array columns as JSON text, whatever their element type, moved to the end."""
    return shards.select(
        *[c for c in shards.columns if c not in arrays],
        *[_as_json_strings(shards, a).alias(a) for a in arrays],
    )


def fix_shards(shards: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """A day range of wide shards with ``cash_movements`` as JSON text."""
    return day_shards(shards, day, first, last).select(
        *[
            _as_json_strings(shards, f.name).alias(f.name)
            if f.name == "cash_movements"
            else F.col(f.name)
            for f in schemas.SHIFTS_WIDE.fields
        ],
        day,
    )


def rewrite_shards(
    shards: DataFrame, day: str, first: str, last: str, path: str | None = None
) -> DataFrame:
    """Write the repaired day range to its own day-partitioned table."""
    path = path or fresh_path(shards.sparkSession, "shifts_fixed")
    return replace_table(fix_shards(shards, day, first, last), path, partition_by=day)


def backfill_shifts(
    target: DataFrame, shards: DataFrame, day: str, first: str, last: str, key: str = "id"
) -> DataFrame:
    """Insert-only merge of a day range of shards into the shift table.

    One job for all days; the earliest day of an id wins.
    """
    days = normalise_shards(day_shards(shards, day, first, last))
    return insert_only_by_day(target, days, key, day)


def backfill_days(
    spark: SparkSession,
    shards: DataFrame,
    day: str,
    first: str,
    last: str,
    target_path: str,
    work_path: str | None = None,
) -> None:
    """As :func:`backfill_shifts`, into the day-partitioned shift table, creating it if absent.

    The range and the earliest day of an id go by the shard's local day; the
    rows are stored under the UTC day, like those of an ingest.
    """
    firsts_path = fresh_path(spark, "shard_firsts")
    rows = first_day_rows(normalise_shards(day_shards(shards, day, first, last)), "id", day)
    try:
        firsts = replace_table(schemas.conform(rows, schemas.SHIFTS), firsts_path)
        merge_days(spark, "shifts", firsts, target_path, "insert", work_path=work_path)
    finally:
        drop_staged(spark, firsts_path)
