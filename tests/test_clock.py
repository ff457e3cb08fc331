from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from helpers import at, one
from pyspark.sql import functions as F

from branchlens.functions import clock


def test_rolling_window_morning_run():
    # 09:30 local on the 16th: until now, since local midnight of the 15th.
    got = clock.rolling_window(datetime(2024, 1, 16, 1, 30, 0, 999))
    assert got == (at("2024-01-14 16:00:00"), at("2024-01-16 01:30:00"))


def test_rolling_window_stops_at_the_cutoff():
    # 11:00 local stops at 10:00, 23:00 local at 22:00.
    assert clock.rolling_window(at("2024-01-16 03:00:00"))[1] == at("2024-01-16 02:00:00")
    assert clock.rolling_window(at("2024-01-16 15:00:00"))[1] == at("2024-01-16 14:00:00")
    # 16:00 local already belongs to the late run, clamped to now.
    assert clock.rolling_window(at("2024-01-16 08:00:00"))[1] == at("2024-01-16 08:00:00")


def test_previous_day_and_range():
    now = datetime(2024, 1, 16, 1, 30, tzinfo=timezone.utc)
    assert clock.previous_day(now) == (at("2024-01-14 16:00:00"), at("2024-01-15 15:59:59"))
    whole = clock.day_range(now, date(2024, 1, 5), date(2024, 1, 9))
    assert whole == (at("2024-01-04 16:00:00"), at("2024-01-09 15:59:59.999999"))
    # One end alone means yesterday.
    assert clock.day_range(now, date(2024, 1, 5))[0] == at("2024-01-14 16:00:00")


def test_aware_moments_are_converted():
    manila = timezone(timedelta(hours=8))
    assert clock.as_utc(datetime(2024, 1, 1, 8, tzinfo=manila)) == at("2024-01-01 00:00:00")


def test_slots_and_day_labels(spark):
    rows = spark.range(24).select(
        F.col("id"), clock.time_slot(F.col("id")).alias("slot")
    ).collect()
    assert [r.id for r in rows if r.slot == "AM"] == list(range(4, 12))
    assert [r.id for r in rows if r.slot == "PM"] == list(range(16, 24))
    for day, label in ((7, "Sun"), (8, "Mon"), (13, "Sat")):
        wall = F.expr(f"TIMESTAMP_NTZ '2024-01-{day:02d} 05:00:00'")
        assert one(spark, clock.day_label(clock.day_number(wall))) == label


def test_local_day_may_differ_from_utc_day(spark):
    utc = F.expr("TIMESTAMP_NTZ '2024-01-06 20:30:00'")
    assert one(spark, clock.second_text(clock.to_local(utc))) == "2024-01-07 04:30:00"


def test_instants_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_LTZ '2024-11-03 05:30:00Z' AS t UNION ALL "
                   "SELECT TIMESTAMP_LTZ '2024-11-03 06:30:00Z'")
    try:
        # The clock repeats the hour 01:00-02:00 in this zone on that day.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = sorted(r[0] for r in df.select(clock.utc_wall(df, "t")).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [at("2024-11-03 05:30:00"), at("2024-11-03 06:30:00")]


def test_window_ends_are_inclusive(spark):
    df = spark.createDataFrame(
        [(at(t),) for t in ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:01")],
        "t timestamp_ntz",
    )
    window = (at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00"))
    assert df.where(clock.in_window(df, "t", window)).count() == 2
