"""The shift fact: one row per AM or PM shift with sales, store name and slot."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchlens.functions import clock
from branchlens.functions.nested import json_array_sum
from branchlens.operators.lookup import UNKNOWN_STORE, lookup_with_default

# Report horizon, tested window, payment amount field.
BASELINE_DAYS = 90
ANALYSIS_DAYS = 7
PAYMENT_AMOUNT = "money_amount"

FACT_COLUMNS = [
    "shift_number", "shift_opening_time", "shift_closing_time", "store_id", "total_sales",
    "day_of_week", "hour_of_day", "store_name", "day_name", "time_slot", "shift_slot",
]


def recent_shifts(
    shifts: DataFrame, as_of: datetime, baseline_days: int = BASELINE_DAYS
) -> DataFrame:
    """Shifts opened within the horizon, its start included."""
    start = clock.as_utc(as_of) - timedelta(days=baseline_days)
    return shifts.where(F.col("opened_at") >= clock.moment_literal(shifts, "opened_at", start))


def add_slot(
    df: DataFrame,
    local: str,
    am: tuple[int, int] = clock.AM_HOURS,
    pm: tuple[int, int] = clock.PM_HOURS,
) -> DataFrame:
    """Day and slot columns from a local time column."""
    return (
        df.withColumn("day_of_week", clock.day_number(F.col(local)))
        .withColumn("hour_of_day", F.hour(local))
        .withColumn("day_name", clock.day_label(F.col("day_of_week")))
        .withColumn("time_slot", clock.time_slot(F.col("hour_of_day"), am, pm))
        .withColumn("shift_slot", clock.slot_label(F.col("day_name"), F.col("time_slot")))
    )


def shift_fact(
    shifts: DataFrame,
    stores: DataFrame,
    as_of: datetime,
    baseline_days: int = BASELINE_DAYS,
    tz: str = clock.LOCAL_TZ,
    am: tuple[int, int] = clock.AM_HOURS,
    pm: tuple[int, int] = clock.PM_HOURS,
    store_rows: int | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Shift fact over the horizon ending ``as_of`` (UTC).

    Opening time is local, closing time stays UTC. Shifts outside both hour
    ranges are dropped. ``store_rows`` is the checked size of ``stores``.
    """
    scanned = recent_shifts(shifts, as_of, baseline_days)
    local = clock.to_local(clock.utc_wall(shifts, "opened_at"), tz)
    in_hours = scanned.where(clock.in_slot(local, am, pm)).select(
        F.col("id").alias("shift_number"),
        local.alias("shift_opening_time"),
        clock.utc_wall(shifts, "closed_at").alias("shift_closing_time"),
        "store_id",
        json_array_sum(F.col("payments"), PAYMENT_AMOUNT, tolerant).alias("total_sales"),
    )
    slotted = add_slot(in_hours, "shift_opening_time", am, pm)
    named = lookup_with_default(
        slotted, stores, "store_id", "store_name", UNKNOWN_STORE, store_rows
    )
    return named.select(*FACT_COLUMNS)


SHIFT_FACT_SQL = """
WITH shift_sales AS (
  SELECT id AS shift_number, opened_at, closed_at, store_id,
         convert_timezone('UTC', :tz, opened_at) AS local_opening,
         coalesce(
           aggregate(payments, 0D,
             (total, p) -> total + coalesce(
               CAST(get_json_object(p, '$.money_amount') AS DOUBLE), 0D)),
           0D) AS total_sales
  FROM {shifts}
  WHERE opened_at >= CAST(:horizon_start AS TIMESTAMP_NTZ)
), slotted AS (
  SELECT *,
         dayofweek(local_opening) AS day_of_week,
         hour(local_opening) AS hour_of_day,
         element_at(array('Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'),
                    dayofweek(local_opening)) AS day_name,
         CASE WHEN hour(local_opening) BETWEEN 4 AND 11 THEN 'AM'
              WHEN hour(local_opening) BETWEEN 16 AND 23 THEN 'PM'
              ELSE 'Other' END AS time_slot
  FROM shift_sales
)
SELECT s.shift_number, s.local_opening AS shift_opening_time,
       s.closed_at AS shift_closing_time, s.store_id, s.total_sales,
       s.day_of_week, s.hour_of_day, s.day_name, s.time_slot,
       s.day_name || '-' || s.time_slot AS shift_slot
FROM slotted s
WHERE s.time_slot <> 'Other'
"""


def shift_fact_sql(
    shifts: DataFrame,
    stores: DataFrame,
    as_of: datetime,
    baseline_days: int = BASELINE_DAYS,
    tz: str = clock.LOCAL_TZ,
    store_rows: int | None = None,
) -> DataFrame:
    """SQL form of :func:`shift_fact` with bound parameters, for UTC ``timestamp_ntz`` tables.

    Stores are looked up as there: broadcast at a checked size, else salted.
    """
    start = clock.as_utc(as_of) - timedelta(days=baseline_days)
    facts = shifts.sparkSession.sql(
        SHIFT_FACT_SQL,
        args={"tz": tz, "horizon_start": start.isoformat(sep=" ")},
        shifts=shifts,
    )
    named = lookup_with_default(
        facts, stores, "store_id", "store_name", UNKNOWN_STORE, store_rows
    )
    return named.select(*FACT_COLUMNS)
