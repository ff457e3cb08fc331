"""What landed records hold beyond the fixed schema: new fields and changed types, per pull."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens import schemas
from branchlens.functions.nested import nesting_parents
from branchlens.sources.files import drop_staged
from branchlens.sources.landing import Quarantine, pull_folder, read_envelopes
from branchlens.sources.tables import read_or_empty, replace_partitions

PULL, ENTITY = "pull", "entity"
UNKNOWN = "none"
DRIFT = T.StructType(
    schemas.strings("entity field landed_type expected_type")
    + schemas.columns(T.LongType(), "records")
    + schemas.strings("pull")
)
# The JSON types a column of each type is read from.
_NUMBER = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT")


def _accepted(dtype: T.DataType) -> tuple[str, ...]:
    if isinstance(dtype, T.DoubleType | T.LongType):
        return _NUMBER
    if isinstance(dtype, T.ArrayType):
        return ("ARRAY",)
    return ("STRING",)


def _named_values(records: DataFrame, parents: set[str], depth: int) -> DataFrame:
    """``name, value`` of every field; objects that may nest columns give ``parent_child`` names."""
    spark = records.sparkSession
    level = records.select(F.lit(None).cast("string").alias("name"), F.col("record").alias("value"))
    out: DataFrame | None = None
    for _ in range(depth):
        fields = spark.sql(
            """
            SELECT concat_ws('_', r.name, f.key) AS name, f.value
            FROM {level} AS r, LATERAL variant_explode(r.value) AS f WHERE f.key IS NOT NULL
            """,
            level=level,
        )
        opens = F.col("name").isin(*parents) & _is_object(F.col("value"))
        leaves = fields.where(~opens)
        out = leaves if out is None else out.unionByName(leaves)
        level = fields.where(opens)
    return out.unionByName(level)


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def landed_drift(
    spark: SparkSession,
    landing: str,
    entity: str,
    pull: str | None = None,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """Fields of a pull that the fixed schema lacks or reads from another JSON type.

    ``landed_type`` is the common type of all values of the field; ``VARIANT`` where they have
    none. ``expected_type`` is the column's type, ``none`` for an unknown field. Fields that are null
    throughout are no drift. The ingest leaves out unknown fields and reads others as null where it cannot convert them.
    """
    schema = schemas.SCHEMAS[entity]
    names = schema.fieldNames()
    # A parent of a parent, such as a of a_b_c, is on the list as well.
    parents = set(nesting_parents(names))
    depth = max(n.count("_") for n in names) + 1
    raw = read_envelopes(
        spark, pull_folder(landing, pull), entity, T.VariantType(), quarantine, pull or "all"
    )
    found = (
        _named_values(raw, parents, depth)
        .groupBy(F.col("name").alias("field"))
        .agg(F.expr("schema_of_variant_agg(value)").alias("landed_type"), F.count("*").alias("records"))
    )
    expected, fits = F.lit(UNKNOWN), F.col("landed_type") == "VOID"
    for field in schema.fields:
        here = F.col("field") == field.name
        expected = F.when(here, field.dataType.simpleString()).otherwise(expected)
        kinds = [F.col("landed_type").startswith(k) for k in _accepted(field.dataType)]
        fits = fits | (here & _any(kinds))
    return found.withColumn("expected_type", expected).where(~fits).select(
        F.lit(entity).alias(ENTITY), "field", "landed_type", "expected_type", "records",
        F.lit(pull or "all").alias(PULL),
    )


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def record_drift(
    spark: SparkSession,
    landing: str,
    entity: str,
    path: str,
    pull: str | None = None,
    quarantine: Quarantine | None = None,
) -> int:
    """Replace the pull's rows in the drift table of ``entity`` below ``path``; also their number."""
    table = f"{path}/{entity}"
    drop_staged(spark, f"{table}/{PULL}={pull or 'all'}")
    found = landed_drift(spark, landing, entity, pull, quarantine)
    replace_partitions(found.drop(ENTITY), table, PULL)
    return read_drift(spark, path, entity).where(F.col(PULL) == (pull or "all")).count()


def read_drift(spark: SparkSession, path: str, entity: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/{entity}", T.StructType([f for f in DRIFT.fields if f.name != ENTITY]))
