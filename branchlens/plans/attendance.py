"""Attendance: time entries -> raw table, and raw payloads -> final table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens import schemas
from branchlens.functions import clock, parsing
from branchlens.operators.merge import upsert
from branchlens.session import fresh_path
from branchlens.sources.files import drop_staged
from branchlens.sources.landing import Quarantine, pull_folder, read_envelopes
from branchlens.sources.publish import refresh_partitions, release_staged
from branchlens.sources.tables import read_or_empty, replace_table

# Each load of the raw table is a partition, named after its pull.
PULL, LOADED = "pull", "load_dt"
DATE = "date"
# Keys of a raw attendance payload.
PAYLOAD_KEYS = (
    "Date", "Full Name", "Group", "EntryType", "Time", "Duration", "Activity", "Kiosk Name",
    "Created On", "Last Edited On",
)


def read_entries(
    spark: SparkSession, landing: str, quarantine: Quarantine | None = None, load: str = "all"
) -> DataFrame:
    """Landed time entries: the raw record as JSON text, and its known fields."""
    raw = read_envelopes(spark, landing, "data", T.VariantType(), quarantine, load).select(
        F.to_json("record").alias("raw_payload")
    )
    return raw.select(
        "raw_payload", F.from_json("raw_payload", schemas.TIME_ENTRY).alias("_e")
    ).select("raw_payload", "_e.*")


def normalise_entries(entries: DataFrame, tz: str = clock.LOCAL_TZ) -> DataFrame:
    """Eleven flat fields per time entry of :func:`read_entries`, the raw record last.

    Alternate field names fill in for null and for empty text. Date and time
    are read as written when the text has no zone, else in local time.
    """

    def text(*names: str) -> Column:
        return parsing.first_filled(*[F.col(n) for n in names])

    moment = text("startedAt", "startAt", "endedAt", "endAt")
    local = clock.to_local(parsing.coerce_timestamp(moment), tz)
    wall = F.when(parsing.has_zone(moment), local).otherwise(moment.try_cast("timestamp_ntz"))
    clock_text = clock.second_text(wall)
    return entries.select(
        F.substring(clock_text, 1, 10).alias("date"),
        F.col("person.name").alias("full_name"),
        F.col("group.name").alias("group_name"),
        text("type", "entryType").alias("entry_type"),
        F.substring(clock_text, 12, 8).alias("time"),
        parsing.seconds_to_hms(F.col("durationSeconds")).alias("duration"),
        F.col("activity.name").alias("activity_name"),
        F.col("kiosk.name").alias("kiosk_name"),
        F.col("createdAt").alias("created_on"),
        text("updatedAt", "lastEditedOn").alias("last_edited_on"),
        "raw_payload",
    )


def entry_moment(entries: DataFrame) -> Column:
    """UTC instant of a time entry; zone-less text is local time."""
    names = ("startedAt", "startAt", "endedAt", "endAt")
    text = parsing.first_filled(*[F.col(n) for n in names])
    local = clock.to_utc(text.try_cast("timestamp_ntz"))
    return F.when(parsing.has_zone(text), parsing.coerce_timestamp(text)).otherwise(local)


def append_entries(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    window: tuple[datetime, datetime] | None = None,
    pull: str | None = None,
    loaded: datetime | None = None,
    quarantine: Quarantine | None = None,
) -> int:
    """Normalise landed time entries and add them to the raw table; also their number.

    Nothing is deduplicated. Each load is one partition of the table: loading a
    named pull again replaces its rows, a load without a name always adds.
    ``window`` keeps entries whose moment lies in it, both ends included.
    ``load_dt`` is the moment of the load in UTC. Without entries the load has no partition.
    """
    entries = read_entries(spark, pull_folder(landing, pull), quarantine, pull or "all")
    if window is not None:
        start, end = (clock.ntz_literal(m) for m in window)
        entries = entries.where(entry_moment(entries).between(start, end))
    moment = loaded or datetime.now(timezone.utc)
    counted = Observation()
    rows = (
        normalise_entries(entries)
        .withColumn(LOADED, clock.ntz_literal(moment))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
    )
    folder = f"{raw_path}/{PULL}={pull or uuid.uuid4().hex}"
    replace_table(rows, folder)
    if not counted.get["rows"]:
        drop_staged(spark, folder)
    return counted.get["rows"]


def read_raw(spark: SparkSession, raw_path: str, pull: str | None = None) -> DataFrame:
    """Raw rows of :func:`append_entries`; of one pull only its partition is read."""
    raw = read_or_empty(spark, raw_path, schemas.RAW_ENTRY)
    return raw if pull is None else raw.where(F.col(PULL) == F.lit(pull))


def entry_payloads(raw: DataFrame) -> DataFrame:
    """Raw time entries as ``payload, load_dt``, the shape the merge reads.

    An assumption: each payload key takes the flat field of the same meaning.
    """
    fields = (
        "date", "full_name", "group_name", "entry_type", "time", "duration", "activity_name",
        "kiosk_name", "created_on", "last_edited_on",
    )
    named = [F.col(f).alias(key) for f, key in zip(fields, PAYLOAD_KEYS, strict=True)]
    return raw.select(F.to_json(F.struct(*named)).alias("payload"), LOADED)


def parse_payloads(raw: DataFrame, tz: str = clock.LOCAL_TZ) -> DataFrame:
    """Raw rows (``payload`` JSON text, ``load_dt``) as typed attendance rows."""
    loads = raw.where(F.col("payload").isNotNull()).select(
        clock.utc_wall(raw, "load_dt").alias("_loaded"), "payload"
    )
    read = parsing.json_texts(loads, "payload", PAYLOAD_KEYS)
    date_text, time_text = F.col("Date"), F.col("Time")
    # A step of its own, since two columns need the date.
    read = read.withColumn("_day", parsing.multi_format_date(date_text))
    name, kind, kiosk = F.col("Full Name"), F.col("EntryType"), F.col("Kiosk Name")
    return read.select(
        parsing.attendance_key(date_text, name, kind, time_text, kiosk).alias("attn_id"),
        F.col("_day").alias("date"),
        name.alias("full_name"),
        F.col("Group").alias("group"),
        kind.alias("entry_type"),
        parsing.local_day_timestamp(F.col("_day"), time_text, tz).alias("time_ts"),
        parsing.hms_to_seconds(F.col("Duration")).alias("duration_sec"),
        F.col("Activity").alias("activity"),
        kiosk.alias("kiosk_name"),
        F.coalesce(
            parsing.strict_timestamp(F.col("Last Edited On")),
            parsing.strict_timestamp(F.col("Created On")),
            F.col("_loaded"),
        ).alias("updated_at"),
    )


def stage_payloads(
    raw: DataFrame, path: str | None = None, tz: str = clock.LOCAL_TZ
) -> DataFrame:
    """Parse raw rows once into a staging table, which the merge then reads."""
    path = path or fresh_path(raw.sparkSession, "attendance_staged")
    return replace_table(parse_payloads(raw, tz), path)


def attendance_upsert(
    target: DataFrame, staged: DataFrame, on_duplicate: str = "error"
) -> DataFrame:
    """Upsert staged attendance rows into the final table.

    The raw table is appended to without deduplication; ``"latest"`` keeps the
    last update of a repeated key, the default refuses it.
    """
    return upsert(target, staged, schemas.MERGE_KEYS["attendance"], on_duplicate, "updated_at")


def merge_attendance(
    spark: SparkSession,
    staged: DataFrame,
    target_path: str,
    on_duplicate: str = "error",
    work_path: str | None = None,
) -> None:
    """Upsert staged attendance rows into the final table, partitioned by date.

    Only the dates of the batch and those that hold its keys are rewritten.
    """
    staging = work_path or fresh_path(spark, "attendance_merged")
    try:
        refresh_partitions(
            spark,
            target_path,
            staged,
            schemas.MERGE_KEYS["attendance"],
            DATE,
            lambda target, source: attendance_upsert(target, source, on_duplicate),
            staging,
        )
    finally:
        if work_path is None:
            release_staged(spark, target_path, staging)


def read_attendance(spark: SparkSession, path: str) -> DataFrame:
    """The final table with its columns in their order."""
    return read_or_empty(spark, path, schemas.ATTENDANCE)
