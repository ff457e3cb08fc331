"""Slot baselines kept as moments per store, slot and day, so that reports need not read 90 days of shifts.

A moment is the number, the mean and the sum of squared deviations of the sales of a group;
moments of parts add up to that of the whole. The kept table has one row per store, slot and
UTC day of opening. It is refreshed for the days whose files changed; reports read its rows
for whole days, and shifts only for the tested days and the days that a window cuts in two.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens import schemas
from branchlens.functions import clock
from branchlens.functions.nested import json_array_sum
from branchlens.operators.baseline import GROUP
from branchlens.operators.lookup import UNKNOWN_STORE, lookup_with_default, with_group_stats
from branchlens.plans import ingest, reports
from branchlens.plans.shift_fact import ANALYSIS_DAYS, BASELINE_DAYS, PAYMENT_AMOUNT, add_slot, shift_fact
from branchlens.sources.files import drop_staged, folder_names, read_text, write_text
from branchlens.sources.tables import read_or_empty, replace_partitions, require_partitioned

_STATE = "_days.json"
KEYS = ["store_id", "shift_slot"]
MOMENTS = T.StructType(
    schemas.strings("store_id shift_slot")
    + schemas.columns(T.LongType(), "n")
    + schemas.columns(T.DoubleType(), "mean m2")
    + schemas.columns(T.DateType(), ingest.DAY)
)


def slot_sales(shifts: DataFrame, tz: str = clock.LOCAL_TZ) -> DataFrame:
    """Store, slot, UTC opening and sales of AM and PM shifts, before any store name."""
    opened = clock.utc_wall(shifts, "opened_at")
    in_hours = shifts.where(clock.in_slot(clock.to_local(opened, tz))).select(
        "store_id",
        opened.alias("opened_at"),
        clock.to_local(opened, tz).alias("_local"),
        json_array_sum(F.col("payments"), PAYMENT_AMOUNT).alias("total_sales"),
    )
    return add_slot(in_hours, "_local").select(*KEYS, "opened_at", "total_sales")


def moments_of(sales: DataFrame, keys: list[str]) -> DataFrame:
    """``n, mean, m2`` of the sales per group."""
    return sales.groupBy(*keys).agg(
        F.count("total_sales").alias("n"),
        F.avg("total_sales").alias("mean"),
        (F.var_pop("total_sales") * F.count("total_sales")).alias("m2"),
    )


def _day_states(spark: SparkSession, path: str) -> dict[str, str]:
    """Day -> a digest of its file names. Every write of a day gives its files new names."""
    days = (n for n in folder_names(spark, path) if n.startswith(f"{ingest.DAY}="))
    return {
        name.partition("=")[2]: hashlib.sha256(
            "\n".join(n for n in folder_names(spark, f"{path}/{name}") if not n.startswith(("_", "."))).encode()
        ).hexdigest()
        for name in days
    }


def refresh_moments(spark: SparkSession, shifts_path: str, path: str, tz: str = clock.LOCAL_TZ) -> list[str]:
    """Bring the kept moments up to date with the shift table; returns the days that were computed anew.

    Days are compared by the names of their files, one short text per day on the driver,
    so it does not matter who changed them. Days that are gone are deleted. The state is
    written last: a run that dies is repeated in full.
    """
    require_partitioned(spark, shifts_path, ingest.DAY)
    now = {d: s for d, s in _day_states(spark, shifts_path).items() if d[:1].isdigit()}
    before = json.loads(read_text(spark, f"{path}/{_STATE}") or "{}")
    changed = sorted(d for d, state in now.items() if before.get(d) != state)
    emptied = set(before) - set(now)
    if changed:
        days = [date.fromisoformat(d) for d in changed]
        table = _shifts_of(spark, shifts_path, days)
        daily = moments_of(slot_sales(table, tz).withColumn(ingest.DAY, F.to_date("opened_at")), [*KEYS, ingest.DAY])
        # A row per store, slot and day.
        daily = daily.select(*MOMENTS.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            replace_partitions(daily, path, ingest.DAY)
            filled = {str(r[0]) for r in daily.select(ingest.DAY).distinct().collect()}
        finally:
            daily.unpersist()
        emptied |= set(changed) - filled
    for day in emptied:
        drop_staged(spark, f"{path}/{ingest.DAY}={day}")
    write_text(spark, f"{path}/{_STATE}", json.dumps(now))
    return changed


def _midnight(moment: datetime) -> bool:
    return moment.time() == time.min


def _shifts_of(spark: SparkSession, shifts_path: str, days: Iterable[date]) -> DataFrame:
    stored = T.StructType([*schemas.SHIFTS.fields, T.StructField(ingest.DAY, T.DateType())])
    return read_or_empty(spark, shifts_path, stored).where(F.col(ingest.DAY).isin(list(days)))


def window_moments(
    spark: SparkSession,
    shifts_path: str,
    path: str,
    since: datetime,
    before: datetime | None = None,
    tz: str = clock.LOCAL_TZ,
) -> DataFrame:
    """Moments per store and slot of the shifts opened from ``since`` (included) to ``before`` (not).

    Several rows per group. Whole days come from the kept table; shifts are read for
    the at most two days that the window cuts.
    """
    day = F.col(ingest.DAY)
    first = since.date() if _midnight(since) else since.date() + timedelta(days=1)
    whole = day >= F.lit(first)
    cut = set() if _midnight(since) else {since.date()}
    opened = F.col("opened_at") >= clock.ntz_literal(since)
    if before is not None:
        whole = whole & (day < F.lit(before.date()))
        cut |= set() if _midnight(before) else {before.date()}
        opened = opened & (F.col("opened_at") < clock.ntz_literal(before))
    columns = [*KEYS, "n", "mean", "m2"]
    kept = read_or_empty(spark, path, MOMENTS).where(whole).select(*columns)
    if not cut:
        return kept
    partial = slot_sales(_shifts_of(spark, shifts_path, cut), tz).where(opened)
    return kept.unionByName(moments_of(partial, KEYS).select(*columns))


def combined(moments: DataFrame, max_groups: int | None = None) -> DataFrame:
    """Mean and sample deviation per (store name, slot) from moments of their parts.

    The deviations of the parts are taken from the common mean, not from the
    difference of large squares.
    """
    means = moments.groupBy(*GROUP).agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_sales"), F.sum("n").alias("_shifts")
    )
    gap = F.col("mean") - F.col("avg_sales")
    parts = with_group_stats(moments, means, GROUP, max_groups)
    return (
        parts.groupBy(*GROUP, "avg_sales", "_shifts")
        .agg(F.sum(F.col("m2") + F.col("n") * gap * gap).alias("_m2"))
        .select(
            *GROUP,
            "avg_sales",
            F.when(F.col("_shifts") > 1, F.sqrt(F.col("_m2") / (F.col("_shifts") - 1))).otherwise(0.0).alias("std_sales"),
        )
    )


class KeptReports:
    """The three reports on the shift fact, their baselines read from kept moments.

    Equal to those of ``plans.reports`` on all facts of the horizon. Shifts are read
    for the tested days and the days the windows cut only.
    """

    def __init__(
        self,
        spark: SparkSession,
        shifts_path: str,
        path: str,
        stores: DataFrame,
        as_of: datetime,
        store_rows: int | None = None,
        max_groups: int | None = None,
        tz: str = clock.LOCAL_TZ,
    ):
        self.spark, self.shifts_path, self.path, self.tz = spark, shifts_path, path, tz
        self.stores, self.as_of, self.store_rows, self.max_groups = stores, as_of, store_rows, max_groups
        self.horizon = clock.as_utc(as_of) - timedelta(days=BASELINE_DAYS)
        self.tested = clock.as_utc(as_of) - timedelta(days=ANALYSIS_DAYS)

    def _named(self, before: datetime | None = None) -> DataFrame:
        rows = window_moments(self.spark, self.shifts_path, self.path, self.horizon, before, self.tz)
        return lookup_with_default(rows, self.stores, "store_id", "store_name", UNKNOWN_STORE, self.store_rows)

    def baseline(self) -> DataFrame:
        """As ``slot_baseline`` of all facts of the horizon."""
        return combined(self._named(), self.max_groups)

    def recent_facts(self) -> DataFrame:
        shifts = ingest.read_days(self.spark, "shifts", self.shifts_path, self.tested)
        return shift_fact(shifts, self.stores, self.as_of, ANALYSIS_DAYS, self.tz, store_rows=self.store_rows)

    def sales_dip(self, k_sigma: float = reports.K_SIGMA, facts: DataFrame | None = None) -> DataFrame:
        recent = self.recent_facts() if facts is None else facts
        judged = with_group_stats(recent, self.baseline(), GROUP, self.max_groups)
        return reports.dip_flags(judged, k_sigma, reports.HARD_RATIO)

    def granular(self, facts: DataFrame | None = None, ordered: bool = False) -> DataFrame:
        usual = self._named(self.tested).groupBy(*GROUP).agg(
            (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("Average Historic Sales")
        )
        recent = self.recent_facts() if facts is None else facts
        return reports.granular_columns(with_group_stats(recent, usual, GROUP, self.max_groups), ordered)

    def summary(self, facts: DataFrame | None = None) -> DataFrame:
        weeks = (BASELINE_DAYS - ANALYSIS_DAYS) / 7.0
        recent = self.recent_facts() if facts is None else facts
        late = recent.groupBy("store_name").agg(F.sum("total_sales").alias("_late"))
        early = self._named(self.tested).groupBy("store_name").agg(
            (F.sum(F.col("n") * F.col("mean")) / F.lit(weeks)).alias("_early")
        )
        return late.join(early, "store_name", "left").select(
            F.col("store_name").alias("Branch"),
            F.col("_late").alias("Sales Amount (Past 7 Days)"),
            F.col("_early").alias("Sales Average per 7 Days"),
        )
