"""Joining points in time to the intervals that contain them, or summing them per interval.

The join adds a time bucket to the equality key. A point has one bucket, an interval one
per bucket it touches, so no match is found twice, and a key that holds a third of all points is
spread over its buckets. A bucket that is hot itself is salted further; the points are read
once more to find such buckets. The sums need no join of points and intervals at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchlens.functions.clock import EPOCH_NTZ
from branchlens.operators.skew import SALT, salt_hot_groups

HOUR = 3600
_FIRST, _LAST, _BUCKET = "_first_bucket", "_last_bucket", "_bucket"
_AT, _KIND, _N = "_at", "_kind", "_n"
# One digit less than a sum may have: adding two such numbers keeps all decimals.
EXACT = "decimal(37,12)"


def time_bucket(at: Column, seconds: int) -> Column:
    """Bucket number of a ``timestamp_ntz``, rising with time."""
    return F.call_function(
        "div",
        at - F.expr(EPOCH_NTZ),
        F.expr(f"INTERVAL '{seconds}' SECOND"),
    )


def _bucketed(points: DataFrame, at: str, seconds: int) -> DataFrame:
    return points.withColumn(_BUCKET, time_bucket(F.col(at), seconds))


def _bounded(intervals: DataFrame, key: str, start: str, end: str, seconds: int) -> DataFrame:
    """Intervals that can contain a point, with their first and last bucket."""
    return (
        intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
        .withColumn(_FIRST, time_bucket(F.col(start), seconds))
        .withColumn(_LAST, time_bucket(F.col(end), seconds))
    )


def _within(
    points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str
) -> DataFrame:
    """Matches among points and intervals that share a bucket."""
    left, right = salt_hot_groups(points, intervals, [key, _BUCKET])
    # The planner does not see how many rows the buckets make of an interval,
    # so it must not choose to broadcast them.
    return (
        left.join(right.hint("merge"), [key, _BUCKET, SALT])
        .where(F.col(at).between(F.col(start), F.col(end)))
        .drop(_BUCKET, SALT)
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    bucket_seconds: int = 6 * HOUR,
) -> DataFrame:
    """Inner join where ``key`` is equal and ``start <= at <= end``.

    A point inside several intervals gives one row per interval.
    """
    touched = (
        _bounded(intervals, key, start, end, bucket_seconds)
        .withColumn(_BUCKET, F.explode(F.sequence(_FIRST, _LAST)))
        .drop(_FIRST, _LAST)
    )
    return _within(_bucketed(points, at, bucket_seconds), touched, key, at, start, end)


def interval_totals(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    group: str,
    value: str,
    groups: tuple[str, ...],
    interval_columns: list[str],
    bucket_seconds: int = 60,
) -> DataFrame:
    """Sum of ``value`` per interval, one column per value of ``group`` listed in ``groups``.

    Equals :func:`interval_join` summed by ``interval_columns``; intervals without a point of
    these groups do not appear, and a group without points sums to 0.0. Null values count
    as 0, yet their point makes its interval appear.

    By prefix sums: the total up to an interval's end minus the total before its start, so
    neither long nor overlapping intervals multiply the points. The points are read once and
    added up per key and moment, then per key and bucket. A running total per key goes over the
    buckets, one row each; another goes over the moments of just those buckets in which
    an interval begins or ends. So no task ever sorts more rows of a key than it has
    buckets, nor of a bucket than the clock has ticks in it. Running totals are
    exact decimals: what two of them have in common cancels without a rest.
    """
    sums = [f"_sum_{i}" for i in range(len(groups))]
    wanted = points.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(group).isin(*groups))
    moments = (
        wanted.withColumn(_BUCKET, time_bucket(F.col(at), bucket_seconds))
        # Said here, since the planner would say it for one of the two uses only and then read the points twice.
        .where(F.col(_BUCKET).isNotNull())
        .groupBy(key, _BUCKET, F.col(at).alias(_AT))
        .agg(
            *[F.sum(F.when(F.col(group) == g, F.col(value))).alias(c) for c, g in zip(sums, groups, strict=True)],
            F.count("*").alias(_N),
        )
        .select(key, _BUCKET, _AT, *[F.coalesce(F.col(c), F.lit(0.0)).cast(EXACT).alias(c) for c in sums], _N)
    )
    totals = [*sums, _N]
    zeros = [*[F.lit(0).cast(EXACT).alias(c) for c in sums], F.lit(0).cast("bigint").alias(_N)]

    bounded = intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    # A start comes before the points of its moment, an end after them.
    ends = bounded.select(
        *interval_columns,
        *([] if key in interval_columns else [key]),
        F.inline(
            F.array(
                F.struct(F.col(start).alias(_AT), F.lit(0).alias(_KIND)),
                F.struct(F.col(end).alias(_AT), F.lit(2).alias(_KIND)),
            )
        ),
    )
    marks = ends.select(key, time_bucket(F.col(_AT), bucket_seconds).alias(_BUCKET), _AT, _KIND).distinct()
    marked = marks.select(key, _BUCKET).distinct()

    def running(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
        """Marks with the totals of the rows before them."""
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        summed = {c: F.sum(c).over(window).cast("bigint" if c == _N else EXACT) for c in totals}
        return rows.withColumns(summed).where(F.col(_KIND) != 1)

    # A semi-join would be moved below the sums, away from those of the other use.
    inside = moments.join(marked, [key, _BUCKET]).withColumn(_KIND, F.lit(1))
    within = running(
        inside.unionByName(marks.select("*", *zeros)), [key, _BUCKET], [_AT, _KIND]
    )
    per_bucket = moments.groupBy(key, _BUCKET).agg(
        *[F.sum(c).cast("bigint" if c == _N else EXACT).alias(c) for c in totals]
    )
    before = running(
        per_bucket.withColumn(_KIND, F.lit(1)).unionByName(marked.select("*", *zeros, F.lit(0).alias(_KIND))),
        [key],
        [_BUCKET, _KIND],
    ).select(key, _BUCKET, *[F.col(c).alias(f"{c}_before") for c in totals])
    prefix = within.join(before, [key, _BUCKET]).select(
        key, _AT, _KIND, *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in totals]
    )
    return (
        ends.join(prefix, [key, _AT, _KIND])
        .groupBy(*interval_columns)
        .agg(*[F.sum(F.when(F.col(_KIND) == 0, -F.col(c)).otherwise(F.col(c))).alias(c) for c in totals])
        .where(F.col(_N) > 0)
        .select(
            *interval_columns,
            *[F.col(c).cast("double").alias(g) for c, g in zip(sums, groups, strict=True)],
        )
    )
