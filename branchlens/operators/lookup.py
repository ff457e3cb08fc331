"""Dimension lookups and per-group statistics joined back to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.operators.skew import BROADCAST_ROWS, SALT, bounded_size, salt_hot_groups

# Fixed value: name of stores the dimension does not know.
UNKNOWN_STORE = "Unknown Store"
# Fixed value: seven days times AM and PM.
SLOTS_PER_STORE = 14


def store_dimension(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """``store_id, store_name`` from a mapping."""
    return spark.createDataFrame(list(names.items()), "store_id string, store_name string")


def lookup_with_default(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    default: str,
    dim_rows: int | None = None,
) -> DataFrame:
    """Left lookup of ``value`` by ``key``; misses and null keys get ``default``.

    ``dim`` has one row per key. Given its checked size in ``dim_rows``, it is
    broadcast; otherwise both sides shuffle on the key, and the rows of a hot
    key spread over as many partitions as their count asks for.
    """
    dim = dim.select(key, value)
    if dim_rows is not None and dim_rows <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(dim), key, "left")
    else:
        left, right = salt_hot_groups(rows, dim, [key])
        joined = left.join(right, [key, SALT], "left")
    joined = joined.select(*rows.columns, value)
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))


def with_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: list[str],
    max_groups: int | None = None,
) -> DataFrame:
    """Left join of one statistics row per group back onto the rows.

    ``stats`` has at most ``max_groups`` rows when that is known, and is then
    broadcast, so ``rows`` is not shuffled at all. Otherwise the rows of a hot
    group spread by their count.
    """
    if max_groups is not None and max_groups <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(stats), keys, "left")
    else:
        left, right = salt_hot_groups(rows, stats, keys)
        joined = left.join(right, [*keys, SALT], "left")
    added = [c for c in stats.columns if c not in keys]
    return joined.select(*rows.columns, *added)


def store_bounds(stores: DataFrame) -> tuple[int | None, int | None]:
    """Checked size of the store dimension and the (store name, slot) groups it allows.

    Both are None for a dimension that is too large to broadcast. A store id
    that repeats is refused: it would multiply its rows.
    """
    known = stores.where(F.col("store_id").isNotNull())
    repeated = known.groupBy("store_id").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"store id repeats: {repeated['store_id']}")
    rows = bounded_size(stores, BROADCAST_ROWS)
    return (None, None) if rows is None else (rows, (rows + 1) * SLOTS_PER_STORE)
