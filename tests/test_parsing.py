from __future__ import annotations

import hashlib

import pytest
from helpers import at, one
from pyspark.sql import functions as F

from branchlens.functions import nested, parsing


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2025-06-01", "2025-06-01"),
        ("2025-6-1", "2025-06-01"),
        ("01/06/2025", "2025-06-01"),
        ("1/6/2025", "2025-06-01"),
        ("31/02/2025", None),
        ("2025-02-30", None),
        ("2025-06", None),
        ("2025-06-01 05:00", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_multi_format_date(spark, value, expected):
    got = one(spark, parsing.multi_format_date(text(value)))
    assert (str(got) if got else None) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("01:02:03", 3723), ("100:00:00", 360000), ("1:2", None), ("a:b:c", None), (None, None)],
)
def test_hms_to_seconds(spark, value, expected):
    assert one(spark, parsing.hms_to_seconds(text(value))) == expected


@pytest.mark.parametrize(
    "value, expected",
    [(0, "00:00:00"), (3723, "01:02:03"), (-3725, "-01:02:05"), (3723.9, "01:02:03"),
     (360000, "100:00:00"), (None, None)],
)
def test_seconds_to_hms(spark, value, expected):
    assert one(spark, parsing.seconds_to_hms(F.lit(value).cast("double"))) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-01T05:00:00Z", "2024-01-01 05:00:00"),
        ("2024-01-01T05:00:00.250Z", "2024-01-01 05:00:00.250"),
        ("2024-01-01T05:00:00+08:00", "2023-12-31 21:00:00"),
        ("2024-01-01T05:00:00+0800", "2023-12-31 21:00:00"),
        ("2024-01-01 05:00:00 UTC", "2024-01-01 05:00:00"),
        ("2024-01-01T05:00:00", "2024-01-01 05:00:00"),
        ("2024-01-01", "2024-01-01 00:00:00"),
        ("not a time", None),
        ("", None),
        (None, None),
    ],
)
def test_coerce_timestamp(spark, value, expected):
    got = one(spark, parsing.coerce_timestamp(text(value)))
    assert got == (at(expected) if expected else None)


def test_strict_timestamp_raises(spark):
    assert one(spark, parsing.strict_timestamp(text(None))) is None
    assert one(spark, parsing.strict_timestamp(text("2024-01-01T05:00:00+08:00"))) == at(
        "2023-12-31 21:00:00"
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, parsing.strict_timestamp(text("not a time")))


def test_local_text_timestamp(spark):
    def parse(day, time):
        return one(spark, parsing.local_text_timestamp(text(day), text(time)))

    assert parse("2025-06-01", "05:30:00") == at("2025-05-31 21:30:00")
    assert parse("01/06/2025", "05:30") == at("2025-05-31 21:30:00")
    assert parse("junk", "05:30:00") is None
    assert parse("2025-06-01", None) is None


def key(spark, *values):
    return one(spark, parsing.attendance_key(*[text(v) for v in values]))


def test_attendance_key(spark):
    expected = hashlib.sha256(b"2025-06-01|Ann|In|05:00|").hexdigest()
    assert key(spark, "2025-06-01", "Ann", "In", "05:00", None) == expected
    # Only the kiosk may be missing; other gaps leave no key.
    for gap in range(4):
        values = ["2025-06-01", "Ann", "In", "05:00", "K1"]
        values[gap] = None
        assert key(spark, *values) is None
    # The raw date text counts, so another layout is another key.
    assert key(spark, "01/06/2025", "Ann", "In", "05:00", None) != expected


def test_json_texts_with_spaces_in_keys(spark):
    payload = '{"Full Name": "Ann", "n": 3, "flag": true, "gone": null}'
    rows = spark.createDataFrame([(payload,)], "payload string")
    keys = ("Full Name", "n", "flag", "gone", "absent")
    got = parsing.json_texts(rows, "payload", keys).first()
    assert tuple(got) == ("Ann", "3", "true", None, None)


def test_first_filled_skips_empty_text(spark):
    assert one(spark, parsing.first_filled(text(""), text(None), text("b"))) == "b"
    assert one(spark, parsing.first_filled(text(""), text(""))) is None


def test_sql_functions_agree_with_the_column_forms(spark):
    from branchlens.functions.sql import register_functions

    register_functions(spark)
    days = ["2025-06-01", "2025-6-1", "01/06/2025", "31/02/2025", "2025-06", "junk", "", None]
    clocks = ["05:30:00", "05:30", "1:2", "a:b:c", "100:00:00", "1:2:3:4", "", None]
    rows = spark.createDataFrame([(d, c) for d in days for c in clocks], "d string, c string")
    got = rows.select(
        F.expr("to_ph_ts(d, c)").alias("sql_ts"),
        parsing.local_text_timestamp(F.col("d"), F.col("c")).alias("ts"),
        F.expr("parse_hms_to_seconds(c)").alias("sql_sec"),
        parsing.hms_to_seconds(F.col("c")).alias("sec"),
    ).collect()
    assert all(r.sql_ts == r.ts and r.sql_sec == r.sec for r in got)
    assert any(r.ts for r in got) and any(r.sec for r in got)


def test_objects_and_lists_are_no_scalars(spark):
    rows = spark.createDataFrame(
        [(1, '{"A b": {"x": 1}, "l": [1], "t": "[x]", "n": 5, "s": "v"}'), (2, "{broken"), (3, None)],
        "id int, payload string",
    )
    got = parsing.json_texts(rows, "payload", ("A b", "l", "t", "n", "s", "gone")).collect()
    assert tuple(got[0]) == (1, None, None, "[x]", "5", "v", None)
    assert [set(r[1:]) for r in got[1:]] == [{None}, {None}]
    documents = F.array(F.lit('{"q": {"x": 1}}'), F.lit('{"q": 2}'), F.lit('{"q": [3]}'))
    assert one(spark, nested.json_array_sum(documents, "q")) == 2.0
