"""Report files: one folder per report, fully replaced on each write."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.clock import instant_to_utc, second_text
from branchlens.sources.files import drop_staged, swap_folder

# Presentation order per report.
SORT_KEYS = {
    "Sales Dip Anomalies": ("store_name", "shift_opening_time"),
    "Ratio Anomalies": ("store_name", "shift_opening_time"),
    "Summary Sales": ("Branch",),
    "Granular Sales": ("_store_id", "_opened"),
}


def report_text(df: DataFrame) -> DataFrame:
    """Time columns as ``yyyy-MM-dd HH:mm:ss`` text, the rest unchanged."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampNTZType):
            return second_text(column).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return second_text(instant_to_utc(column)).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def report_path(folder: str, name: str) -> str:
    return f"{folder}/{name.lower().replace(' ', '_')}"


def write_report(df: DataFrame, folder: str, name: str) -> bool:
    """Replace the report's CSV files; an empty report leaves the old ones alone.

    The new files are written beside the old ones and then take their place.
    Sort keys that start with an underscore are not written.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if kept.isEmpty():
            return False
        keys = [k for k in SORT_KEYS.get(name, ()) if k in kept.columns]
        ordered = kept.orderBy(*[F.col(f"`{k}`") for k in keys]) if keys else kept
        written = ordered.drop(*[k for k in keys if k.startswith("_")])
        path = report_path(folder, name)
        new = f"{path}.new-{uuid.uuid4().hex}"
        try:
            report_text(written).write.option("header", True).csv(new)
            swap_folder(df.sparkSession, new, path)
        finally:
            drop_staged(df.sparkSession, new)
        return True
    finally:
        kept.unpersist()
