"""The attendance conversions as functions callable from Spark SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from branchlens.functions.clock import LOCAL_TZ

# Function names that queries on attendance tables use.
LOCAL_TIMESTAMP = "to_ph_ts"
SECONDS = "parse_hms_to_seconds"


def register_functions(spark: SparkSession, tz: str = LOCAL_TZ) -> None:
    """Define both functions for this session; they are inlined, like any SQL function.

    Same meaning as ``parsing.local_text_timestamp`` and ``parsing.hms_to_seconds``.
    """
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {LOCAL_TIMESTAMP}(day STRING, clock STRING)
        RETURNS TIMESTAMP_NTZ
        RETURN convert_timezone('{tz}', 'UTC', try_cast(
          CASE WHEN day RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$'
               THEN cast(try_cast(day AS DATE) AS STRING)
               WHEN day RLIKE '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$'
               THEN cast(try_cast(concat_ws('-', split_part(day, '/', 3), split_part(day, '/', 2),
                                            split_part(day, '/', 1)) AS DATE) AS STRING)
          END || ' ' || clock AS TIMESTAMP_NTZ))
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {SECONDS}(duration STRING)
        RETURNS BIGINT
        RETURN CASE WHEN size(split(duration, ':')) = 3 THEN
          try_cast(split_part(duration, ':', 1) AS BIGINT) * 3600
          + try_cast(split_part(duration, ':', 2) AS BIGINT) * 60
          + try_cast(split_part(duration, ':', 3) AS BIGINT) END
        """
    )
