"""Time handling: UTC wall clock in storage, branch-local time in the logic.

Stored instants are ``timestamp_ntz`` columns holding UTC, so no result
depends on the session time zone. Tables that use ``timestamp`` instead are
accepted and converted on read by :func:`utc_wall`.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Branch time zone, slot hours, day labels.
LOCAL_TZ = "Asia/Manila"
AM_HOURS = (4, 11)
PM_HOURS = (16, 23)
DAY_LABELS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# Fixed values of the twice-daily pull: the run before 16:00 local stops at
# 10:00, the later one at 22:00.
RUN_SPLIT_HOUR = 16
MORNING_CUTOFF_HOUR = 10
EVENING_CUTOFF_HOUR = 22

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_utc(moment: datetime) -> datetime:
    """Naive values are taken as UTC; aware ones are converted."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def utc_wall(df: DataFrame, name: str) -> Column:
    """Column ``name`` as UTC ``timestamp_ntz``, whatever timestamp type it has."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return instant_to_utc(F.col(name))
    return F.col(name)


def instant_to_utc(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH_NTZ))


def moment_literal(df: DataFrame, name: str, moment: datetime) -> Column:
    """Literal typed like column ``name``, so comparisons reach the file scan."""
    text = as_utc(moment).isoformat(sep=" ", timespec="microseconds")
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.expr(f"TIMESTAMP_LTZ '{text}Z'")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def ntz_literal(moment: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{as_utc(moment).isoformat(sep=' ', timespec='microseconds')}'")


def to_local(utc: Column, tz: str = LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def to_utc(local: Column, tz: str = LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def second_text(wall: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz``; zone-free on purpose."""
    return F.substring(wall.cast("string"), 1, 19)


def day_number(local: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(local)


def day_label(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_LABELS]), number)


def time_slot(
    hour: Column, am: tuple[int, int] = AM_HOURS, pm: tuple[int, int] = PM_HOURS
) -> Column:
    return F.when(hour.between(*am), "AM").when(hour.between(*pm), "PM").otherwise("Other")


def in_slot(
    local: Column, am: tuple[int, int] = AM_HOURS, pm: tuple[int, int] = PM_HOURS
) -> Column:
    hour = F.hour(local)
    return hour.between(*am) | hour.between(*pm)


def slot_label(day: Column, slot: Column) -> Column:
    return F.concat_ws("-", day, slot)


# --- ingest windows -------------------------------------------------------


def _local_to_utc(wall: datetime, tz: str) -> datetime:
    return as_utc(wall.replace(tzinfo=ZoneInfo(tz)))


def _local_now(now_utc: datetime, tz: str) -> datetime:
    aware = as_utc(now_utc).replace(tzinfo=timezone.utc)
    return aware.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def rolling_window(now_utc: datetime, tz: str = LOCAL_TZ) -> tuple[datetime, datetime]:
    """UTC bounds of the twice-daily pull, at second precision.

    Starts at local midnight of the day before; ends at the run's cut-off hour,
    or now when the run is early.
    """
    now = _local_now(now_utc, tz)
    midnight = datetime.combine(now.date(), time.min)
    cutoff_hour = MORNING_CUTOFF_HOUR if now.hour < RUN_SPLIT_HOUR else EVENING_CUTOFF_HOUR
    end = min(midnight + timedelta(hours=cutoff_hour), now)
    start = midnight - timedelta(days=1)
    return _local_to_utc(start, tz), _local_to_utc(end.replace(microsecond=0), tz)


def previous_day(now_utc: datetime, tz: str = LOCAL_TZ) -> tuple[datetime, datetime]:
    """UTC bounds of the whole local day before, 00:00:00 to 23:59:59."""
    day = _local_now(now_utc, tz).date() - timedelta(days=1)
    return (
        _local_to_utc(datetime.combine(day, time.min), tz),
        _local_to_utc(datetime.combine(day, time(23, 59, 59)), tz),
    )


def day_range(
    now_utc: datetime,
    first: date | None = None,
    last: date | None = None,
    tz: str = LOCAL_TZ,
) -> tuple[datetime, datetime]:
    """UTC bounds of an inclusive local day range; yesterday unless both ends are given."""
    if first is None or last is None:
        first = last = _local_now(now_utc, tz).date() - timedelta(days=1)
    return (
        _local_to_utc(datetime.combine(first, time.min), tz),
        _local_to_utc(datetime.combine(last, time.max), tz),
    )


def in_window(df: DataFrame, name: str, window: tuple[datetime, datetime]) -> Column:
    """Both ends inclusive."""
    start, end = window
    return F.col(name).between(moment_literal(df, name, start), moment_literal(df, name, end))
