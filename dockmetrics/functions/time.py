"""Event time and the calendar keys taken from it.

Day and hour are computed from the epoch second, so a row lands in the same UTC
partition whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmetrics.model import require_columns

_DAY_SECONDS = 86_400
_HOUR_SECONDS = 3_600


def utc_day(timestamp: str | Column) -> Column:
    """UTC calendar date of a timestamp."""
    seconds = F.unix_seconds(timestamp)
    return F.date_from_unix_date(F.floor(seconds / _DAY_SECONDS).cast("int"))


def utc_hour(timestamp: str | Column) -> Column:
    """UTC hour of day, 0 to 23."""
    seconds = F.unix_seconds(timestamp)
    return F.floor(F.pmod(seconds, F.lit(_DAY_SECONDS)) / _HOUR_SECONDS).cast("int")


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``timestamp`` from the epoch seconds in ``last_reported``."""
    require_columns(df, ["last_reported"])
    return df.withColumn("timestamp", F.timestamp_seconds("last_reported"))


def with_day(df: DataFrame) -> DataFrame:
    """Add ``day``, the UTC date of ``timestamp``."""
    require_columns(df, ["timestamp"])
    return df.withColumn("day", utc_day("timestamp"))


def with_partition_keys(df: DataFrame) -> DataFrame:
    """Add the history's partition columns: the full date and the hour."""
    require_columns(df, ["timestamp"])
    return df.withColumns({"day": utc_day("timestamp"), "hour": utc_hour("timestamp")})
