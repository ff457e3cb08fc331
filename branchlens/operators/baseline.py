"""Slot statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["store_name", "shift_slot"]


def sample_std(name: str) -> Column:
    """Sample deviation; 0 where one value leaves it undefined."""
    return F.coalesce(F.stddev_samp(name), F.lit(0.0))


def slot_baseline(facts: DataFrame, value: str = "total_sales") -> DataFrame:
    """Mean and sample deviation per (store, slot)."""
    return facts.groupBy(*GROUP).agg(
        F.avg(value).alias("avg_sales"), sample_std(value).alias("std_sales")
    )


def item_pivot(
    sold: DataFrame, shift_columns: list[str], items: tuple[str, ...], value: str = "quantity"
) -> DataFrame:
    """One row per shift, one column per item, 0 where the item is missing.

    The items are known, so this is one aggregate with a condition per column.
    Shifts without id or store are left out.
    """
    present = F.lit(True)
    for column in shift_columns:
        present = present & F.col(column).isNotNull()
    return (
        sold.where(present)
        .groupBy(*shift_columns)
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("name") == item, F.col(value))), F.lit(0.0)).alias(
                    item
                )
                for item in items
            ]
        )
    )


def slot_baseline_by_day(facts: DataFrame, day: str, value: str = "total_sales") -> DataFrame:
    """The slot baseline in window form: one row per (store, slot, day).

    A window over all shifts of a slot would sort a hot slot in one task. Here
    each day is first reduced to its count, mean and squared deviation, so a
    window partition holds at most one row per day of the horizon.
    """
    daily = facts.groupBy(*GROUP, day).agg(
        F.count(value).alias("_n"),
        F.avg(value).alias("_mean"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("_m2"),
    )
    slot = Window.partitionBy(*GROUP)
    shifts = F.sum("_n").over(slot)
    mean = F.sum(F.col("_n") * F.col("_mean")).over(slot) / shifts
    with_mean = daily.withColumn("_shifts", shifts).withColumn("avg_sales", mean)
    gap = F.col("_mean") - F.col("avg_sales")
    spread = F.sum(F.col("_m2") + F.col("_n") * gap * gap).over(slot)
    return with_mean.withColumn(
        "std_sales",
        F.when(F.col("_shifts") > 1, F.sqrt(spread / (F.col("_shifts") - 1))).otherwise(0.0),
    ).select(*GROUP, day, "avg_sales", "std_sales")
