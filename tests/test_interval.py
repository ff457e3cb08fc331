from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest
from helpers import at, bag, final_plan
from pyspark.sql import functions as F

from branchlens.operators import skew
from branchlens.operators.interval_join import interval_join, interval_totals

START = at("2024-01-01 00:00:00")
POINTS = "store string, at timestamp_ntz, item string, qty double"
SPANS = "shift string, store string, opened timestamp_ntz, closed timestamp_ntz"


def sample(seed: int, points: int = 400, spans: int = 60):
    """Points and overlapping spans, a third of both at one store."""
    rng = random.Random(seed)

    def store():
        return "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None])

    def moment(days=6):
        # Whole minutes, so that points fall exactly on span ends.
        return START + timedelta(minutes=rng.randrange(days * 1440))

    left = [
        (store(), moment(), rng.choice("xy"), rng.choice([1.0, 2.0, None])) for _ in range(points)
    ]
    right = []
    for i in range(spans):
        opened = moment()
        hours = rng.choice([0, 1, 8, 30, 80, 140, -1])
        right.append((f"s{i}", store(), opened, opened + timedelta(hours=hours)))
    # Points on both ends of a span, and a copy of each.
    for shift in right[:20]:
        left += [(shift[1], shift[2], "x", 1.0), (shift[1], shift[3], "y", 1.0)] * 2
    return left, right


def brute(left, right):
    return [
        (p, s) for p in left for s in right
        if p[0] is not None and p[0] == s[1] and s[2] <= p[1] <= s[3]
    ]


KEYS = dict(key="store", at="at", start="opened", end="closed")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [3600, 6 * 3600, 86400])
@pytest.mark.parametrize("hot_copies", [1_000_000, 3])
def test_join_equals_brute_force(spark, monkeypatch, seed, bucket, hot_copies):
    monkeypatch.setattr(skew, "HOT_COPIES", hot_copies)
    left, right = sample(seed)
    got = interval_join(
        spark.createDataFrame(left, POINTS),
        spark.createDataFrame(right, SPANS),
        **KEYS, bucket_seconds=bucket,
    )
    want = Counter((s[0], p[1], p[2], p[3]) for p, s in brute(left, right))
    assert bag(got, "shift", "at", "item", "qty") == want


TOTALS = dict(**KEYS, group="item", value="qty", groups=("x", "y"))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bucket", [60, 1, 7200])
def test_totals_equal_brute_force(spark, seed, bucket):
    left, right = sample(seed)
    right += right[:5]  # repeated rows of an interval add up
    left += [("a", None, "x", 1.0), ("a", START, "z", 5.0)]
    got = interval_totals(
        spark.createDataFrame(left, POINTS), spark.createDataFrame(right, SPANS), **TOTALS,
        interval_columns=["shift", "store"], bucket_seconds=bucket,
    )
    want = {}
    for p, s in brute([p for p in left if p[1] is not None and p[2] in "xy"], right):
        cell = want.setdefault((s[0], s[1]), {"x": 0.0, "y": 0.0})
        cell[p[2]] += p[3] or 0.0
    assert {(r["shift"], r["store"]): {"x": r["x"], "y": r["y"]} for r in got.collect()} == want
    assert got.count() == len(want)


def test_totals_leave_no_rest(spark):
    """Fractions before an interval cancel; what is sold and returned in it sums to zero."""
    rows = [("a", START + timedelta(seconds=i), "x", 0.1) for i in range(1000)]
    inside = START + timedelta(hours=1)
    rows += [("a", inside, "x", 0.3), ("a", inside, "x", -0.3), ("a", inside, "y", 1 / 3)]
    spans = [("s", "a", inside, inside), ("empty", "a", inside + timedelta(seconds=1), inside + timedelta(days=1))]
    got = interval_totals(
        spark.createDataFrame(rows, POINTS), spark.createDataFrame(spans, SPANS), **TOTALS,
        interval_columns=["shift"],
    ).collect()
    assert [(r["shift"], r["x"]) for r in got] == [("s", 0.0)]
    assert got[0]["y"] == pytest.approx(1 / 3, abs=1e-12)


def test_totals_of_nothing(spark):
    left, right = sample(1)
    points, spans = spark.createDataFrame(left, POINTS), spark.createDataFrame(right, SPANS)
    for none in ((points.where("false"), spans), (points, spans.where("false"))):
        assert interval_totals(*none, **TOTALS, interval_columns=["shift"]).count() == 0


def test_plan_reads_the_points_once_and_joins_no_pairs(spark, tmp_path):
    left, right = sample(5)
    for name, rows, fields in (("points", left, POINTS), ("spans", right, SPANS)):
        spark.createDataFrame(rows, fields).write.parquet(str(tmp_path / name))
    got = interval_totals(
        spark.read.parquet(str(tmp_path / "points")), spark.read.parquet(str(tmp_path / "spans")),
        **TOTALS, interval_columns=["shift", "store"],
    )
    text = final_plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line and "item#" in line]
    assert len(scans) == 1


def test_open_span_over_ninety_days_stays_small(spark):
    spans = spark.createDataFrame(
        [("open", "a", START, START + timedelta(days=90))], SPANS
    )
    points = spark.range(2000).select(
        F.lit("a").alias("store"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id"))).alias("at"),
        F.lit("x").alias("item"),
        F.lit(1.0).alias("qty"),
    )
    got = interval_totals(points, spans, **TOTALS, interval_columns=["shift"])
    assert got.first()["x"] == 2000.0
