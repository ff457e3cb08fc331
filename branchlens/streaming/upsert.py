"""Available-now stream from landed files into a merged, partitioned table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from branchlens import schemas
from branchlens.operators.merge import insert_only, upsert
from branchlens.plans import ingest
from branchlens.sources.files import drop_staged
from branchlens.sources.landing import (
    CHECKED,
    Quarantine,
    checked_schema,
    envelope_schema,
    explode_envelopes,
    refuse_broken,
    set_aside,
    with_origin,
)
from branchlens.sources.publish import refresh_partitions

_ARRIVED, _KEY = "_arrived", "_state_key"


def batch_path(work_path: str, number: int) -> str:
    """Where a micro-batch is staged."""
    return f"{work_path}/staged/batch={number}"


def stream_upsert(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target_path: str,
    key: str,
    partition_by: str,
    work_path: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    mode: str = "upsert",
    on_duplicate: str = "error",
    order_by: str | None = None,
    files_per_batch: int = 1_000,
    quarantine: Quarantine | None = None,
    seen_within: str | None = None,
) -> StreamingQuery:
    """Start merging all landed JSON files not seen before; the query ends by itself.

    ``schema`` is that of a landed line, ``prepare`` makes table rows of such
    lines. A line that is no JSON stops the query. Files may lie in folders per
    pull. Each micro-batch rewrites only the partitions it touches. Batches are
    staged under their number and published against the table's version, so a batch
    replayed after a failure is neither merged twice nor undoes what others merged since. ``work_path`` must be the
    same in every run: it holds the stream's checkpoint. ``mode="insert"`` adds
    new keys only; it looks them up in the table, so no state grows with the
    number of keys. With ``seen_within``, an interval such as ``3 days``, records whose key
    arrived that recently do not even reach the look-up: the first arrival
    counts, also among copies in one micro-batch. Keys that return later are
    still found in the table. A ``quarantine`` takes lines that are no JSON, per batch.
    """

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        if mode == "insert":
            return insert_only(target, source, key)
        return upsert(target, source, key, on_duplicate, order_by)

    if seen_within is not None and (mode != "insert" or quarantine is not None):
        raise ValueError("seen_within is for streams that insert only, without a quarantine")

    def write(batch: DataFrame, number: int) -> None:
        # A batch starts only after the one before is committed for good.
        drop_staged(batch.sparkSession, batch_path(work_path, number - 1))
        if seen_within is not None:
            rows = batch
        elif quarantine is not None:
            rows = prepare(set_aside(batch, quarantine, f"batch-{number}"))
        else:
            rows = prepare(refuse_broken(batch))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            refresh_partitions(
                batch.sparkSession,
                target_path,
                rows,
                key,
                partition_by,
                merge,
                batch_path(work_path, number),
            )
        finally:
            rows.unpersist()

    lines = (
        spark.readStream.schema(checked_schema(schema))
        .options(**CHECKED)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    if quarantine is not None:
        lines = with_origin(lines)
    if seen_within is not None:
        lines = first_arrivals(prepare(refuse_broken(lines)), key, seen_within)
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{work_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def first_arrivals(records: DataFrame, key: str, within: str) -> DataFrame:
    """A stream's records without those whose key arrived in the time ``within`` before.

    The state holds one key per record of that time and no more. The time is that of
    arrival, the start of the micro-batch, so no record is ever late and dropped for it. Null
    keys never match and all stay.
    """
    state_key = F.coalesce(F.col(key).cast("string"), F.expr("concat('null ', uuid())"))
    return (
        records.withColumn(_ARRIVED, F.current_timestamp())
        .withColumn(_KEY, state_key)
        .withWatermark(_ARRIVED, within)
        .dropDuplicatesWithinWatermark([_KEY])
        .drop(_ARRIVED, _KEY)
    )


def stream_ingest(
    spark: SparkSession,
    entity: str,
    landing: str,
    target_path: str,
    work_path: str,
    mode: str = "upsert",
    on_duplicate: str = "latest",
    files_per_batch: int = 1_000,
    quarantine: Quarantine | None = None,
    seen_within: str | None = None,
) -> StreamingQuery:
    """Merge landed API pages of ``entity`` into its day-partitioned table.

    Overlapping pulls may fall into one batch, so the later copy of a record is
    kept by default.
    """
    schema = schemas.SCHEMAS[entity]

    def prepare(pages: DataFrame) -> DataFrame:
        records = ingest.conformed_records(explode_envelopes(pages, entity), schema)
        return ingest.with_day(records, entity)

    return stream_upsert(
        spark,
        landing,
        envelope_schema(entity, schemas.record_schema(schema)),
        target_path,
        schemas.MERGE_KEYS[entity],
        ingest.DAY,
        work_path,
        prepare,
        mode,
        on_duplicate,
        ingest.UPDATED[entity],
        files_per_batch,
        quarantine,
        seen_within,
    )
