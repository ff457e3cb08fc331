"""Keyed merges as pure functions ``(target, source) -> new target``.

Null keys never match: null-key source rows are always added and null-key
target rows always stay. Columns are matched by name.

Whole rows are only ever joined to a table with one row per source key, which
is combined on the map side first; see ``operators.skew`` for repeated keys.
A source is read more than once (its keys, then its rows); stage it as a table
when it is costly to compute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.clock import EPOCH_NTZ
from branchlens.operators.skew import join_repeated, join_unique

_COPIES, _FIRST, _RANK = "_copies", "_first", "_rank"
_EARLIEST = -(1 << 63)


def _order_number(df: DataFrame, name: str) -> Column | None:
    """The order column as a bigint; None for types whose order no bigint keeps."""
    dtype, column = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.call_function("div", column - F.expr(EPOCH_NTZ), F.expr("INTERVAL '0.000001' SECOND"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return column.cast("bigint")
    return None


def tie_number(columns: list[str]) -> Column:
    """60 bits that settle ties: the first 15 hex digits of the md5 of the values as text.

    The texts are joined by character 31; a null is character 30.
    """
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *texts)), 1, 15), 16, 10)


def latest_per_key(source: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per non-null key, the greatest by ``order_by``; null keys all stay.

    A null counts as the earliest. Of equally late rows that with the greatest :func:`tie_number` of the
    remaining columns wins. Rows are numbered per key, and each task that reads the source passes on
    only its first of a key, so the copies of a hot key shrink before the shuffle and a key never has
    more rows after it than there were tasks. For an order that is neither time, date nor whole
    number, the remaining columns settle ties in their order instead.
    """
    others = [c for c in source.columns if c not in (key, order_by)]
    keyed = source.where(F.col(key).isNotNull())
    number = _order_number(source, order_by)
    if number is None:
        best = (
            keyed.groupBy(key)
            .agg(F.max(F.struct(order_by, *others)).alias("_best"))
            .select(key, "_best.*")
            .select(*source.columns)
        )
    else:
        moment = F.coalesce(number, F.lit(_EARLIEST))
        first = Window.partitionBy(key).orderBy(moment.desc(), tie_number(others).cast("bigint").desc())
        ranked = keyed.withColumn(_RANK, F.row_number().over(first))
        best = ranked.where(F.col(_RANK) == 1).select(*source.columns)
    return best.unionByName(source.where(F.col(key).isNull()))


def _key_copies(source: DataFrame, key: str) -> DataFrame:
    return source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(_COPIES))


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    on_duplicate: str = "error",
    order_by: str | None = None,
) -> DataFrame:
    """Replace matched target rows by their source row, add unmatched source rows.

    Every column is taken from the source, nulls included. Two source rows for
    one target row raise when the result is computed; ``on_duplicate="latest"``
    keeps the greatest ``order_by`` per key instead.
    """
    keys = _key_copies(source, key)
    if on_duplicate == "latest":
        if order_by is None:
            raise ValueError("on_duplicate='latest' needs order_by")
        source = latest_per_key(source, key, order_by)
        keys = keys.withColumn(_COPIES, F.lit(1))
    elif on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")

    clash = F.raise_error(
        F.concat(
            F.lit("several source rows match one target row, key "), F.col(key).cast("string")
        )
    ).cast("boolean")
    untouched = (
        join_unique(target, keys, key, "left")
        .where(F.when(F.col(_COPIES) > 1, clash).otherwise(F.col(_COPIES).isNull()))
        .select(*target.columns)
    )
    return untouched.unionByName(source)


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Add source rows whose key is not in the target; leave target rows alone.

    Duplicates inside the source are all added.
    """
    known = target.where(F.col(key).isNotNull()).select(key)
    counts = _key_copies(source, key)
    new_keys = counts.join(known, key, "left_anti")
    fresh = (
        join_repeated(source, new_keys, key, "left", _COPIES, counts)
        .where(F.col(key).isNull() | F.col(_COPIES).isNotNull())
        .select(*source.columns)
    )
    return target.unionByName(fresh)


def insert_only_by_day(target: DataFrame, shards: DataFrame, key: str, day: str) -> DataFrame:
    """Insert-only merge of many daily shards, run in day order, as one job.

    The first day that brings a key wins; duplicates within that day all stay,
    and so do rows without key.
    """
    known = target.where(F.col(key).isNotNull()).select(key)
    all_days = (
        shards.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(day).alias(_FIRST), F.count("*").alias(_COPIES))
    )
    first_days = all_days.join(known, key, "left_anti")
    fresh = (
        join_repeated(shards, first_days, key, "left", _COPIES, all_days)
        .where(F.col(key).isNull() | (F.col(day) == F.col(_FIRST)))
        .select(*target.columns)
    )
    return target.unionByName(fresh)


def first_day_rows(shards: DataFrame, key: str, day: str) -> DataFrame:
    """Of each key the rows of its earliest day; rows without key all stay."""
    firsts = (
        shards.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(day).alias(_FIRST), F.count("*").alias(_COPIES))
    )
    return (
        join_repeated(shards, firsts, key, "left", _COPIES)
        .where(F.col(key).isNull() | (F.col(day) == F.col(_FIRST)))
        .select(*shards.columns)
    )


def merge_metrics(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``metric, n``: rows on both sides, matched target rows and rows after an upsert."""
    marked = join_unique(target.select(key), _key_copies(source, key), key, "left")
    sizes = marked.agg(F.count("*").alias("t"), F.count(_COPIES).alias("m")).selectExpr(
        "stack(2, 'target_rows', t, 'matched_rows', m) as (metric, n)"
    )
    batch = source.agg(F.count("*").alias("n")).selectExpr("'source_rows' as metric", "n")
    parts = sizes.unionByName(batch)
    after = parts.agg(
        F.sum(F.when(F.col("metric") == "matched_rows", -F.col("n")).otherwise(F.col("n"))).alias(
            "n"
        )
    ).selectExpr("'rows_after' as metric", "n")
    return parts.unionByName(after)
