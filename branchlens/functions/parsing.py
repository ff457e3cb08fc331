"""Text parsing for attendance rows and landed timestamps.

Three conversions are known only by their names and call sites: local date and
time text to an instant, ``H:M:S`` to seconds, and seconds to ``HH:MM:SS``.
Each lives in one function here, so a different meaning changes one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.functions.clock import LOCAL_TZ, instant_to_utc, to_utc

# A clock time followed by a zone name or offset at the end of the text.
_ZONED = r"(?i)\d:\d{2}.*?(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?)$"
# The two accepted date layouts, year-month-day and day/month/year.
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def has_zone(text: Column) -> Column:
    """Whether a time text names its offset."""
    return text.endswith("Z") | text.rlike(_ZONED)


def json_texts(rows: DataFrame, payload: str, keys: tuple[str, ...]) -> DataFrame:
    """The scalar texts under top-level keys of a JSON column, which they replace.

    Keys may contain spaces; a missing key, an object or list under it, or a
    malformed payload gives null. The payload is parsed in one go; only where a text
    looks like an object or list they are looked up again, to tell it from a string.
    That rare step is one column of its own: written out per key next to what uses the
    texts, it makes a method too long for the JVM to compile.
    """
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    read = rows.withColumn("_texts", F.from_json(payload, schema))

    def looks_nested(text: Column) -> Column:
        return text.startswith("{") | text.startswith("[")

    def scalar(key: str) -> Column:
        text = F.col("_texts").getField(key)
        value = F.try_variant_get(F.try_parse_json(payload), f"$['{key}']", "variant")
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        return F.when(looks_nested(text), F.when(~nested, text)).otherwise(text).alias(key)

    texts = F.array(*[F.col("_texts").getField(key) for key in keys])
    scalars = F.struct(*[scalar(key) for key in keys])
    checked = F.when(F.exists(texts, looks_nested), scalars).otherwise(F.col("_texts"))
    others = [c for c in rows.columns if c != payload]
    found = [F.col("_scalars").getField(key).alias(key) for key in keys]
    return read.withColumn("_scalars", checked).select(*others, *found)


def attendance_key(
    date_text: Column, name: Column, entry_type: Column, time_text: Column, kiosk: Column
) -> Column:
    """Hex SHA-256 of the five raw texts; null when any but the kiosk is missing.

    Uses the raw date text, so one day written in two formats gives two keys.
    """
    bar = F.lit("|")
    parts = F.concat(
        date_text, bar, name, bar, entry_type, bar, time_text, bar, F.coalesce(kiosk, F.lit(""))
    )
    return F.sha2(parts, 256)


def multi_format_date(text: Column) -> Column:
    """ISO first, then day/month/year, else null.

    Both layouts go through one cast: date patterns would throw and catch an
    exception for every text that does not match. Only a text with a slash is rewritten.
    """
    iso = F.when(text.contains("/"), F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")).otherwise(text)
    return F.when(iso.rlike(_ISO_DATE), iso.try_cast("date"))


def local_text_timestamp(date_text: Column, time_text: Column, tz: str = LOCAL_TZ) -> Column:
    """Local date and time texts to a UTC instant; malformed gives null."""
    return local_day_timestamp(multi_format_date(date_text), time_text, tz)


def local_day_timestamp(day: Column, time_text: Column, tz: str = LOCAL_TZ) -> Column:
    """As :func:`local_text_timestamp`, of a date that is read already."""
    wall = F.concat(day.cast("string"), F.lit(" "), time_text)
    return to_utc(wall.try_cast("timestamp_ntz"), tz)


def hms_to_seconds(text: Column) -> Column:
    """``H:M:S`` to seconds; anything else is null."""
    parts = F.split(text, ":")

    def part(n: int) -> Column:
        return F.try_element_at(parts, F.lit(n)).try_cast("bigint")

    return F.when(F.size(parts) == 3, part(1) * 3600 + part(2) * 60 + part(3))


def seconds_to_hms(seconds: Column) -> Column:
    """Seconds to ``HH:MM:SS``; hours may pass 24, one sign leads if negative, null stays null."""
    signed = seconds.cast("bigint")
    whole = F.abs(signed)

    def padded(number: Column) -> Column:
        digits = number.cast("bigint").cast("string")
        return F.when(number < 10, F.concat(F.lit("0"), digits)).otherwise(digits)

    colon = F.lit(":")
    hours, minutes = F.floor(whole / 3600), F.floor((whole % 3600) / 60)
    sign = F.when(signed < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, padded(hours), colon, padded(minutes), colon, padded(whole % 60))


def coerce_timestamp(text: Column) -> Column:
    """Text to a UTC ``timestamp_ntz``: zone-less text is UTC, malformed is null."""
    return F.when(has_zone(text), instant_to_utc(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def strict_timestamp(text: Column) -> Column:
    """As :func:`coerce_timestamp`, but malformed text raises under ANSI mode."""
    return F.coalesce(coerce_timestamp(text), text.cast("timestamp_ntz"))


def first_filled(*texts: Column) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])
