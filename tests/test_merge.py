from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from helpers import at, bag, final_plan
from pyspark.sql import functions as F

from branchlens.operators import merge, skew

SCHEMA = "id string, v int, w string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def target(spark):
    return frame(spark, [("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")])


def test_upsert_replaces_adds_and_keeps(spark, target):
    source = frame(spark, [("b", 20, None), ("c", 30, "n"), (None, 40, "m")])
    assert bag(merge.upsert(target, source, "id")) == {
        ("a", 1, "x"): 1,
        ("b", 20, None): 1,  # nulls overwrite
        ("c", 30, "n"): 1,
        (None, 3, "z"): 1,  # null keys never match
        (None, 40, "m"): 1,
    }


def test_upsert_matches_columns_by_name(spark, target):
    source = frame(spark, [("new", "b", 20)], "w string, id string, v int")
    assert ("b", 20, "new") in bag(merge.upsert(target, source, "id"))


def test_upsert_twice_is_once(spark, target):
    source = frame(spark, [("b", 20, "q"), ("c", 30, "n")])
    once = merge.upsert(target, source, "id")
    assert bag(merge.upsert(once, source, "id")) == bag(once)


def test_upsert_refuses_two_rows_for_one_target_row(spark, target):
    source = frame(spark, [("b", 20, "p"), ("b", 21, "q")])
    with pytest.raises(Exception, match="several source rows match"):
        merge.upsert(target, source, "id").collect()
    with pytest.raises(ValueError):
        merge.upsert(target, source, "id", on_duplicate="latest")
    with pytest.raises(ValueError):
        merge.upsert(target, source, "id", on_duplicate="first")


def test_duplicates_without_target_row_are_all_added(spark, target):
    source = frame(spark, [("n", 1, "p"), ("n", 1, "p")])
    assert bag(merge.upsert(target, source, "id"))[("n", 1, "p")] == 2


def test_upsert_latest(spark, target):
    source = frame(
        spark, [("b", 20, "p"), ("b", 21, "q"), ("b", None, "r"), (None, 5, "s"), (None, 5, "s")]
    )
    got = bag(merge.upsert(target, source, "id", "latest", "v"))
    assert got[("b", 21, "q")] == 1
    assert got[(None, 5, "s")] == 2
    assert sum(got.values()) == 5


def test_upsert_into_nothing(spark):
    source = frame(spark, [("a", 1, "x")])
    assert bag(merge.upsert(frame(spark, []), source, "id")) == {("a", 1, "x"): 1}
    assert bag(merge.upsert(source, frame(spark, []), "id")) == {("a", 1, "x"): 1}


def test_insert_only(spark, target):
    source = frame(spark, [("b", 20, "q"), ("c", 30, "n"), ("c", 30, "n"), (None, 40, "m")])
    assert bag(merge.insert_only(target, source, "id")) == {
        ("a", 1, "x"): 1,
        ("b", 2, "y"): 1,
        (None, 3, "z"): 1,
        ("c", 30, "n"): 2,
        (None, 40, "m"): 1,
    }


def test_insert_only_by_day_first_day_wins(spark, target):
    shards = frame(
        spark,
        [
            ("a", 9, "known", "d1"),
            ("n", 2, "late", "d2"),
            ("n", 1, "first", "d1"),
            ("n", 1, "first", "d1"),
            (None, 7, "x", "d1"),
            (None, 8, "y", "d2"),
        ],
        SCHEMA + ", ds string",
    )
    got = bag(merge.insert_only_by_day(target, shards, "id", "ds")) - bag(target)
    assert got == {("n", 1, "first"): 2, (None, 7, "x"): 1, (None, 8, "y"): 1}
    # One day after the other gives the same table.
    stepwise = target
    for day in ("d1", "d2"):
        stepwise = merge.insert_only(stepwise, shards.where(F.col("ds") == day).drop("ds"), "id")
    assert bag(stepwise) - bag(target) == got


def test_metrics(spark, target):
    source = frame(spark, [("b", 20, "q"), ("c", 30, "n"), (None, 1, "m")])
    got = dict(bag(merge.merge_metrics(target, source, "id")).keys())
    assert got == {"target_rows": 3, "matched_rows": 1, "source_rows": 3, "rows_after": 5}
    assert merge.upsert(target, source, "id").count() == 5


@pytest.mark.parametrize("hot_copies", [1_000_000, 100])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_and_null_keys(spark, monkeypatch, hot_copies, broadcast):
    monkeypatch.setattr(skew, "HOT_COPIES", hot_copies)
    # A third of the rows share one key and are exact copies, a third have none.
    rows = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
        .alias("id"),
        F.lit(1).alias("v"),
        F.lit("w").alias("w"),
        F.when(F.col("id") % 2 == 0, "d1").otherwise("d2").alias("ds"),
    )
    target = frame(spark, [("other", 1, "x"), ("1", 5, "x")])
    source = rows.drop("ds")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        added = merge.insert_only(target, source, "id")
        assert bag(added) == bag(target) + bag(source.where("id IS NULL OR id <> '1'"))
        by_day = merge.insert_only_by_day(target, rows, "id", "ds")
        first = rows.where("id IS NULL OR (id <> '1' AND (id <> 'hot' OR ds = 'd1'))").drop("ds")
        assert bag(by_day) == bag(target) + bag(first)
        latest = merge.latest_per_key(source, "id", "v")
        assert latest.count() == 3000 + 1 + 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_without_broadcast(spark, target):
    source = frame(spark, [("b", 20, "q"), ("c", 30, "n"), (None, 1, "m")])
    want = bag(merge.upsert(target, source, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.upsert(target, source, "id")
        text = final_plan(merged)
        assert "SortMergeJoin" in text and "NestedLoop" not in text
        # Null keys are spread: the salt is part of the shuffle key.
        joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
        assert all("_salt" in line.split("LeftOuter")[0] for line in joins)
        assert bag(merged) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- the latest row of a key ----------------------------------------------


def plain_tie(values):
    text = "\x1f".join("\x1e" if v is None else str(v) for v in values)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_latest_row_by_time_then_tie_number(spark):
    """Times before 1970, equal times, null times, exact copies and null values."""
    rng = random.Random(3)
    times = [None, at("1969-12-31 23:59:59.999999"), at("1970-01-01 00:00:00"), at("2024-05-06 07:08:09.000001"), at("9999-12-31 00:00:00")]
    rows = [(f"k{rng.randrange(25)}", rng.choice(times), rng.choice(["p", "q", None]), rng.randrange(3)) for _ in range(300)]
    rows += rows[:40]
    want = {}
    for key, time, word, number in rows:
        rank = (time is not None, time or 0, plain_tie([word, number]))
        if key not in want or rank > want[key][0]:
            want[key] = (rank, (key, time, word, number))
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, "id string, t timestamp_ntz, w string, n int").withColumn("t", F.col("t").cast(kind))
        latest = merge.latest_per_key(df, "id", "t")
        got = bag(latest.withColumn("t", F.col("t").cast("timestamp_ntz")))
        assert got == Counter(row for _, row in want.values())


def test_latest_row_by_other_types(spark):
    rows = [("a", "2024-01-05", 2, 1.5, [1]), ("a", "2024-01-04", 9, 2.5, [2]), ("b", None, None, None, None), (None, "2024-01-01", 1, 1.0, [])]
    df = spark.createDataFrame(rows, "id string, d string, n long, x double, l array<int>").withColumn("d", F.to_date("d"))
    for order, value in (("d", 2), ("n", 9), ("x", 9)):
        got = {(r.id, r.n) for r in merge.latest_per_key(df, "id", order).collect()}
        assert got == {("a", value), ("b", None), (None, 1)}


def test_latest_row_reads_and_shuffles_the_source_once(spark, tmp_path):
    """Each task passes on one row of a key, however many copies it has read."""
    path = str(tmp_path / "source")
    hot = spark.range(0, 3000, 1, 3).selectExpr("'hot' AS id", "CAST(id % 700 AS int) AS v", "'w' AS w")
    hot.unionByName(frame(spark, [("a", None, "x"), ("a", None, "x")])).write.parquet(path)
    latest = merge.latest_per_key(spark.read.parquet(path).where("id IS NOT NULL"), "id", "v")
    assert bag(latest) == {("hot", 699, "w"): 1, ("a", None, "x"): 1}
    text = final_plan(latest)
    assert "Join" not in text and "Aggregate" not in text
    assert text.count("Exchange hashpartitioning") == 1
    # What is passed on is cut before the shuffle, which lies above it in the plan.
    assert text.index("Exchange hashpartitioning") < text.index(", Partial")


def test_latest_row_needs_no_sorted_aggregate(spark):
    df = frame(spark, [("b", 20, "q"), ("b", 21, "n"), (None, 1, "m")])
    assert "SortAggregate" not in final_plan(merge.upsert(df, df, "id", "latest", "v"))
