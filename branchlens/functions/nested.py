"""JSON text, arrays and nested structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_NULLS = {"ignoreNullFields": "false"}


def empty_array(element: str) -> Column:
    return F.array().cast(f"array<{element}>")


def json_array_sum(documents: Column, field: str, tolerant: bool = False) -> Column:
    """Sum of one numeric field over an array of JSON documents, within the row.

    Missing fields, objects and lists count as nothing; null or empty arrays
    give 0. A malformed number raises under ANSI mode unless ``tolerant``.
    """

    def number(document: Column) -> Column:
        found = F.get_json_object(document, f"$.{field}")
        text = F.when(~found.rlike(r"^[{\[]"), found)
        value = text.try_cast("double") if tolerant else text.cast("double")
        return F.coalesce(value, F.lit(0.0))

    total = F.aggregate(documents, F.lit(0.0), lambda acc, doc: acc + number(doc))
    return F.coalesce(total, F.lit(0.0))


def _variant_elements(value: Column, dtype: T.DataType) -> Column:
    """The value as ``array<variant>``, or null when it is no list."""
    if isinstance(dtype, T.StringType):
        value = F.try_parse_json(value)
    return value.try_cast("array<variant>")


def array_to_json_strings(value: Column, dtype: T.DataType) -> Column:
    """Each list element as JSON text, null fields kept; a non-list gives ``[]``.

    Takes arrays of structs or scalars, variants, and JSON text.
    """
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.StructType | T.MapType | T.ArrayType | T.VariantType):
            texts = F.transform(value, lambda x: F.to_json(x, KEEP_NULLS))
        else:
            texts = F.transform(value, lambda x: F.to_json(x.cast("variant")))
        # A null element is the JSON document `null`, like any other element.
        texts = F.transform(texts, lambda x: F.coalesce(x, F.lit("null")))
    elif isinstance(dtype, T.StringType | T.VariantType):
        texts = F.transform(_variant_elements(value, dtype), lambda x: F.to_json(x))
    else:
        texts = F.lit(None).cast("array<string>")
    return F.coalesce(texts, empty_array("string"))


def array_int_or_empty(value: Column, dtype: T.DataType) -> Column:
    """List elements as bigint; a non-list gives ``[]``."""
    if not isinstance(dtype, T.ArrayType):
        value = _variant_elements(value, dtype)
    return F.coalesce(F.transform(value, lambda x: x.cast("bigint")), empty_array("bigint"))


def array_struct_or_empty(value: Column, dtype: T.DataType) -> Column:
    """The list as JSON texts if every element is an object, else ``[]``."""
    elements = _variant_elements(value, dtype)
    all_objects = F.forall(elements, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    kept = F.when(all_objects, F.transform(elements, lambda x: F.to_json(x)))
    return F.coalesce(kept, empty_array("string"))


def _splits(name: str) -> list[tuple[str, ...]]:
    """Every way a flat name may nest: ``a_b_c`` as a.b_c, a_b.c and a.b.c."""
    parts = name.split("_")
    out = []
    for mask in range(1, 1 << (len(parts) - 1)):
        steps = [parts[0]]
        for i, part in enumerate(parts[1:]):
            if mask >> i & 1:
                steps.append(part)
            else:
                steps[-1] += "_" + part
        out.append(tuple(steps))
    return out


def nesting_parents(names: list[str]) -> list[str]:
    """Fields under which the value of a flat column may be nested."""
    parents = {steps[0] for name in names for steps in _splits(name)}
    return sorted(parents - set(names))


def lift_nested(df: DataFrame, names: list[str]) -> DataFrame:
    """Flat columns, filled from nested records where the record has no such field.

    The parents of :func:`nesting_parents` are variants, so any JSON under
    their names is read; they are dropped.
    """
    parents = set(nesting_parents(names)) & set(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def filled(name: str) -> Column:
        nested = [
            F.try_variant_get(F.col(steps[0]), "$." + ".".join(steps[1:]), types[name])
            for steps in _splits(name)
            if steps[0] in parents
        ]
        return F.coalesce(F.col(name), *nested).alias(name)

    return df.select(*[filled(c) for c in df.columns if c not in parents])


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs become ``parent_child`` columns; lists stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))
