"""Landed API pages: one JSON envelope per line, ``{<key>: [record, ...], cursor}``."""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.sources.files import drop_staged, folder_names

_BROKEN = "_broken"
FILE, OFFSET, LOAD = "file", "offset", "load"


def envelope_schema(key: str, record: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(key, T.ArrayType(record)), T.StructField("cursor", T.StringType())]
    )


def explode_envelopes(pages: DataFrame, key: str) -> DataFrame:
    """All records of all pages; a page without the key adds none.

    Struct records become columns, others one column named ``record``.
    """
    records = pages.select(F.explode(key).alias("record"))
    if isinstance(records.schema["record"].dataType, T.StructType):
        return records.select("record.*")
    return records


def pull_folder(landing: str, pull: str | None) -> str:
    """Folder of one pull, ``<landing>/pull=<name>``; without a name the whole folder.

    Only that folder is listed and read, however long the landing history is.
    """
    if pull is None:
        return landing
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", pull):
        raise ValueError(f"not a pull name: {pull}")
    return f"{landing.rstrip('/')}/pull={pull}"


def checked_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the column that takes lines which could not be read."""
    return T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])


CHECKED = {"columnNameOfCorruptRecord": _BROKEN}


class TooManyBroken(ValueError):
    """A load holds more broken lines than its quarantine takes."""


@dataclass(frozen=True)
class Quarantine:
    """Side table for landed lines that are no JSON, and how many of them one load may have."""

    path: str
    limit: int = 100


def _is_broken() -> Column:
    """Spark also marks lines where it could not convert a field; those parse."""
    return F.col(_BROKEN).isNotNull() & F.try_parse_json(_BROKEN).isNull()


def refuse_broken(lines: DataFrame) -> DataFrame:
    """Lines read with :func:`checked_schema` and ``CHECKED``; raises on one that is no JSON."""
    refuse = F.raise_error(F.concat(F.lit("landed page is no JSON: "), F.col(_BROKEN)))
    return lines.where(F.when(_is_broken(), refuse.cast("boolean")).otherwise(True)).drop(_BROKEN)


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines with the file and the byte offset of the part of it they were read from."""
    return lines.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(OFFSET))


def set_aside(lines: DataFrame, quarantine: Quarantine, load: str) -> DataFrame:
    """The lines that are JSON; the others go to the quarantine table, under the load's name.

    ``lines`` as of :func:`with_origin`. One pass over them counts the broken ones while writing
    them; beyond the limit it raises, with the lines written for inspection. Setting a load aside
    again replaces its lines.
    """
    counted = Observation()
    # Spark does not read the broken column alone, hence the other.
    fields = [F.col(f"`{c}`").isNotNull() for c in lines.columns if c not in (_BROKEN, FILE, OFFSET)]
    broken = lines.where(_is_broken()).select(
        FILE, OFFSET, F.col(_BROKEN).alias("line"), reduce(operator.or_, fields).alias("partly_read")
    )
    folder = f"{quarantine.path}/{LOAD}={load}"
    broken.observe(counted, F.count(F.lit(1)).alias("lines")).write.mode("overwrite").parquet(folder)
    found = counted.get["lines"]
    if found > quarantine.limit:
        raise TooManyBroken(f"{found} landed lines of {load} are no JSON, over {quarantine.limit}; see {folder}")
    if not found:
        drop_staged(lines.sparkSession, folder)
    return lines.where(~_is_broken()).drop(_BROKEN, FILE, OFFSET)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, line, partly_read, load`` of all lines set aside."""
    schema = T.StructType.fromDDL(
        f"{FILE} string, {OFFSET} long, line string, partly_read boolean, {LOAD} string"
    )
    if not any(n.startswith(f"{LOAD}=") for n in folder_names(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_envelopes(
    spark: SparkSession,
    path: str,
    key: str,
    record: T.DataType,
    quarantine: Quarantine | None = None,
    load: str = "all",
) -> DataFrame:
    """Records of every page under ``path``, read with a fixed schema.

    A line that is no JSON raises instead of vanishing with all its records, unless a
    quarantine takes it; a single field of the wrong type only becomes null.
    """
    reader = spark.read.schema(checked_schema(envelope_schema(key, record))).options(**CHECKED)
    pages = reader.json(path)
    if quarantine is None:
        return explode_envelopes(refuse_broken(pages), key)
    return explode_envelopes(set_aside(with_origin(pages), quarantine, load), key)
