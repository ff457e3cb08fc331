"""Fixed table schemas and projection onto them.

Instants are ``timestamp_ntz`` in UTC (see ``functions.clock``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.clock import instant_to_utc
from branchlens.functions.nested import array_to_json_strings, nesting_parents
from branchlens.functions.parsing import coerce_timestamp

_TEXTS = T.ArrayType(T.StringType())
_NAMED = T.StructType([T.StructField("name", T.StringType())])


def columns(dtype: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, dtype) for name in names.split()]


def strings(names: str) -> list[T.StructField]:
    return columns(T.StringType(), names)


def times(names: str) -> list[T.StructField]:
    return columns(T.TimestampNTZType(), names)


# Column names, order and types of the stored tables.
RECEIPTS = T.StructType(
    strings("receipt_number receipt_type source")
    + times("created_at updated_at")
    + columns(T.DoubleType(), "total_money total_tax")
    + columns(T.LongType(), "points_earned points_spent points_balance")
    + columns(_TEXTS, "line_items payments")
    + strings("note customer_id employee_id store_id")
)
SHIFTS = T.StructType(
    strings("id store_id pos_device_id opened_by_employee closed_by_employee")
    + times("opened_at closed_at")
    + columns(T.DoubleType(), "expected_cash actual_cash")
    + columns(_TEXTS, "cash_movements payments taxes")
)
# The daily shift shard of the older ingest: taxes are numbers.
SHIFTS_SHARD = T.StructType(
    [
        T.StructField(f.name, T.ArrayType(T.LongType())) if f.name == "taxes" else f
        for f in SHIFTS.fields
    ]
)
# The wide daily shard of the older generation, arrays as stored after repair.
SHIFTS_WIDE = T.StructType(
    strings("id store_id pos_device_id")
    + times("opened_at closed_at")
    + strings("opened_by_employee closed_by_employee")
    + columns(
        T.DoubleType(),
        "starting_cash cash_payments cash_refunds paid_in paid_out expected_cash actual_cash "
        "gross_sales refunds discounts net_sales tip surcharge",
    )
    + columns(_TEXTS, "taxes payments cash_movements")
)
ATTENDANCE = T.StructType(
    strings("attn_id")
    + columns(T.DateType(), "date")
    + strings("full_name group entry_type")
    + times("time_ts")
    + columns(T.LongType(), "duration_sec")
    + strings("activity kiosk_name")
    + times("updated_at")
)
TIME_ENTRY = T.StructType(
    strings("startedAt startAt endedAt endAt")
    + columns(_NAMED, "person group activity kiosk")
    + strings("type entryType")
    + columns(T.DoubleType(), "durationSeconds")
    + strings("createdAt updatedAt lastEditedOn")
)
# The raw attendance table: flat entry fields, the load, its partition.
RAW_ENTRY = T.StructType(
    strings(
        "date full_name group_name entry_type time duration activity_name kiosk_name created_on "
        "last_edited_on raw_payload"
    )
    + times("load_dt")
    + strings("pull")
)
# Merge key per entity.
MERGE_KEYS = {"receipts": "receipt_number", "shifts": "id", "attendance": "attn_id"}
SCHEMAS = {"receipts": RECEIPTS, "shifts": SHIFTS}


def landing_schema(schema: T.StructType) -> T.StructType:
    """Read schema for landed JSON: times as text, whole numbers as doubles, lists as variants.

    A variant accepts any JSON value, so a record whose list field holds
    something else still loads and is repaired by :func:`conform`. A whole
    number may be landed as ``3.0``, which a bigint column would not read.
    """

    def relaxed(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.TimestampNTZType | T.TimestampType):
            return T.StringType()
        if isinstance(dtype, T.LongType):
            return T.DoubleType()
        if isinstance(dtype, T.ArrayType):
            return T.VariantType()
        return dtype

    return T.StructType([T.StructField(f.name, relaxed(f.dataType)) for f in schema.fields])


def record_schema(schema: T.StructType) -> T.StructType:
    """:func:`landing_schema` and the fields that may nest its columns, as variants."""
    parents = nesting_parents(schema.fieldNames())
    return T.StructType(
        [*landing_schema(schema).fields, *[T.StructField(p, T.VariantType()) for p in parents]]
    )


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    present = field.name in df.columns
    value = F.col(f"`{field.name}`") if present else F.lit(None)
    source = df.schema[field.name].dataType if present else T.NullType()
    if field.dataType == T.ArrayType(T.StringType()):
        # Arrays of text are taken as JSON documents already.
        if source == field.dataType:
            return F.coalesce(value, F.array().cast(field.dataType))
        return array_to_json_strings(value, source)
    if isinstance(field.dataType, T.TimestampNTZType):
        if isinstance(source, T.StringType):
            return coerce_timestamp(value)
        if isinstance(source, T.TimestampType):
            return instant_to_utc(value)
    return value.cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: missing columns null, extra ones dropped, order fixed.

    List columns become arrays of JSON text (``[]`` when absent or no list);
    malformed times become null.
    """
    return df.select(*[_conformed(df, f).alias(f.name) for f in schema.fields])


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to the planner by the filter: it then leaves out joins with them."""
    return spark.createDataFrame([], schema).where(F.lit(False))
