from __future__ import annotations

import json

import pytest
from helpers import one
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions import nested


def texts(spark, sql):
    df = spark.sql(f"SELECT {sql} AS v")
    return df.select(nested.array_to_json_strings(F.col("v"), df.schema["v"].dataType)).first()[0]


def loaded(values):
    return [json.loads(v) for v in values]


def test_array_sum(spark):
    def total(documents, tolerant=False):
        column = F.lit(None).cast("array<string>") if documents is None else F.array(
            *[F.lit(d).cast("string") for d in documents]
        )
        return one(spark, nested.json_array_sum(column, "money_amount", tolerant))

    assert total(['{"money_amount": 1.5}', '{"money_amount": "2"}', '{"other": 9}', None]) == 3.5
    assert total([]) == 0.0
    assert total(None) == 0.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        total(['{"money_amount": "x"}'])
    assert total(['{"money_amount": "x"}', '{"money_amount": 4}'], tolerant=True) == 4.0


def test_json_strings_keep_null_fields(spark):
    got = texts(spark, "array(named_struct('a', 1, 'b', CAST(NULL AS INT)))")
    assert loaded(got) == [{"a": 1, "b": None}]


def test_json_strings_of_scalars_and_gaps(spark):
    assert texts(spark, "array(1, 2)") == ["1", "2"]
    assert texts(spark, "array('a\"b')") == ['"a\\"b"']
    assert texts(spark, "array(CAST(NULL AS INT), 2)") == ["null", "2"]
    assert texts(spark, "CAST(array() AS array<int>)") == []
    assert texts(spark, "CAST(NULL AS array<struct<a:int>>)") == []


def test_json_strings_of_mixed_lists(spark):
    assert loaded(texts(spark, """'[{"b":1,"a":null},3,"s",null]'""")) == [
        {"b": 1, "a": None}, 3, "s", None,
    ]
    assert texts(spark, """'{"a":1}'""") == []
    assert texts(spark, "'not json'") == []
    assert texts(spark, """parse_json('[1,{"a":2}]')""") == ["1", '{"a":2}']
    assert texts(spark, "5") == []


def test_ints_or_empty(spark):
    def ints(value):
        return one(spark, nested.array_int_or_empty(F.lit(value).cast("string"), T.StringType()))

    assert ints("[1, 2.0, 3]") == [1, 2, 3]
    assert ints('{"a": 1}') == []
    assert ints(None) == []
    assert one(spark, nested.array_int_or_empty(F.array(F.lit("4")), T.ArrayType(T.StringType()))) == [4]


def test_objects_or_empty(spark):
    def objects(value):
        return one(spark, nested.array_struct_or_empty(F.lit(value).cast("string"), T.StringType()))

    assert loaded(objects('[{"a":1},{"b":null}]')) == [{"a": 1}, {"b": None}]
    assert objects('[{"a":1},2]') == []
    assert objects("[]") == []
    assert objects('{"a":1}') == []
    assert objects(None) == []


def test_flatten(spark):
    df = spark.sql(
        "SELECT 1 AS a, named_struct('x', 2, 'deep', named_struct('y', 3)) AS n, array(named_struct('z', 4)) AS l"
    )
    flat = nested.flatten_structs(df)
    assert flat.columns == ["a", "n_x", "n_deep_y", "l"]
    assert flat.first()[:3] == (1, 2, 3)
    missing = spark.sql("SELECT CAST(NULL AS struct<x:int>) AS n")
    assert nested.flatten_structs(missing).first()["n_x"] is None
