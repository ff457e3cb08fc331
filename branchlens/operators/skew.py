"""Shared ways to keep hot keys from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT, _PARTS, _N = "_salt", "_parts", "_n"
# Rows of one key that one task takes; a key with more of them is spread over
# as many tasks as that makes.
HOT_COPIES = 1_000_000
# Entries the broadcast list of hot keys may have.
HOT_KEYS = 100_000
# Rows and bytes of text a side may have to be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 100_000_000


def _row_hash(df: DataFrame) -> Column:
    """Hash of the row's values and its input partition.

    The values alone would keep exact copies together; the input partition
    spreads those too. A retried task has the same input, hence the same hash.
    """
    hashable = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if not isinstance(f.dataType, T.MapType | T.VariantType)
    ]
    return F.xxhash64(*hashable, F.spark_partition_id())


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _listed(counts: DataFrame, keys: list[str], copies: str) -> DataFrame:
    """Keys to spread and over how many salts: the ``HOT_KEYS`` largest of those that need it.

    A key that is not listed has at most ``HOT_COPIES`` rows, or less than one in
    ``HOT_KEYS`` of all.
    """
    parts = F.ceil(F.col(copies) / F.lit(HOT_COPIES)).cast("bigint")
    hot = counts.where(F.col(copies) > HOT_COPIES).orderBy(F.desc(copies)).limit(HOT_KEYS)
    return hot.select(*keys, parts.alias(_PARTS))


def _salted_rows(rows: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a salt: by hash for listed keys, 0 for others, anything for null keys.

    Null keys never match, so they may go anywhere.
    """
    marked = rows.join(F.broadcast(hot), keys, "left")
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    salt = (
        F.when(any_null, _row_hash(rows))
        .when(F.col(_PARTS).isNotNull(), F.pmod(_row_hash(rows), F.col(_PARTS)))
        .otherwise(_zero())
    )
    return marked.withColumn(SALT, salt).drop(_PARTS)


def _repeated(other: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """The other side, once per salt of its key."""
    marked = other.join(F.broadcast(hot), keys, "left")
    salts = F.sequence(_zero(), F.coalesce(F.col(_PARTS), F.lit(1).cast("bigint")) - 1)
    return marked.withColumn(SALT, F.explode(salts)).drop(_PARTS)


def join_unique(rows: DataFrame, per_key: DataFrame, key: str, how: str) -> DataFrame:
    """Join rows that have about one row per non-null key, such as a merged table.

    ``per_key`` has one row per key and is not repeated. Should some key repeat
    a lot after all, adaptive execution splits its partition.
    """
    spread = F.when(F.col(key).isNull(), _row_hash(rows)).otherwise(_zero())
    left = rows.withColumn(SALT, spread)
    # Exploded, since the planner would fold a constant out of the join key.
    right = per_key.withColumn(SALT, F.explode(F.array(_zero())))
    return left.join(right, [key, SALT], how).drop(SALT)


def join_repeated(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    how: str,
    copies: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join rows whose keys may repeat without limit.

    ``per_key`` has one row per key and tells in ``copies`` how many rows have
    it. Rows of a key with over ``HOT_COPIES`` of them are spread over as many
    partitions as its count asks for, and only such keys are repeated per salt.
    ``counts`` may name a table that is cheaper to find these keys in, with the
    same two columns and maybe more keys.
    """
    hot = _listed(per_key if counts is None else counts, [key], copies)
    left, right = _salted_rows(rows, hot, [key]), _repeated(per_key, hot, [key])
    return left.join(right, [key, SALT], how).drop(SALT)


def salt_hot_groups(
    rows: DataFrame, other: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an inner or left join on ``keys``, with a salt to join on as well.

    The rows are counted per key first. Those of a group with over
    ``HOT_COPIES`` rows are spread by their number, and the other side is
    repeated for just these groups. Null keys never match and go anywhere.
    """
    counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(_N))
    hot = _listed(counts, keys, _N)
    return _salted_rows(rows, hot, keys), _repeated(other, hot, keys)


def bounded_size(df: DataFrame, limit: int = BROADCAST_ROWS) -> int | None:
    """Row count of a table small enough to broadcast, or None.

    Both its rows and the bytes of its values as text are checked.
    """
    text = F.lit(0).cast("bigint")
    for name in df.columns:
        text = text + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    rows, size = df.limit(limit + 1).agg(F.count("*"), F.sum(text)).first()
    return rows if rows <= limit and (size or 0) <= BROADCAST_BYTES else None
