"""Adapters that read the driver's ``events`` and ``customer`` tables as feeds.

Epoch seconds are taken from the zone-less ``ts`` without passing through the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_SECONDS = "(unix_date(cast(ts as date)) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts))"

#: The user's station; every 50th user is at one that the dimension lacks.
_STATION = "case when user_id % 50 = 7 then concat('x', user_id) else cast(user_id as string) end"


def _events(spark: SparkSession, sf_dir: str, tick: int = 60) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') as int) as k",
        f"{_SECONDS} - pmod({_SECONDS}, {tick}) as last_reported",
    )


def station_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations."""
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .selectExpr(
            "cast(c_custkey as string) as station_id",
            "cast(10 + c_custkey % 20 as int) as capacity",
            "c_name as name",
        )
    )


def station_status(spark: SparkSession, sf_dir: str, tick: int = 60) -> DataFrame:
    """Each event as a status report of its user's station, at a multiple of
    ``tick`` seconds: whole minutes let stations share a time, as a poll does."""
    return _events(spark, sf_dir, tick).selectExpr(
        f"{_STATION} as station_id",
        "cast(k % (11 + user_id % 20) as int) as num_bikes_available",
        "cast(10 + user_id % 20 - k % (11 + user_id % 20) as int) as num_docks_available",
        "last_reported",
    )


def free_bike_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a report of a bike; there are 25 reports per bike."""
    fleet = max(1, spark.read.parquet(f"{sf_dir}/events.parquet").count() // 25)
    return _events(spark, sf_dir).selectExpr(
        f"cast(event_id % {fleet} as string) as bike_id",
        f"case when event_type = 'error' then '' else {_STATION} end as station_id",
        "last_reported",
        "k % 3 = 0 as is_reserved",
        "k % 5 = 0 as is_disabled",
        "cast(floor(value * 100) as int) as current_range_meters",
    )


def status_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed document per event: its station's status, and that of a second
    station (id prefixed ``n``) with bikes and docks swapped."""
    first = (
        "named_struct('station_id', station_id, 'num_bikes_available', num_bikes_available,"
        " 'num_docks_available', num_docks_available, 'last_reported', last_reported,"
        " 'vehicle_types', array(named_struct('count', num_bikes_available)))"
    )
    second = (
        "named_struct('station_id', concat('n', station_id),"
        " 'num_bikes_available', num_docks_available,"
        " 'num_docks_available', num_bikes_available, 'last_reported', last_reported,"
        " 'vehicle_types', array(named_struct('count', num_docks_available)))"
    )
    feed = f"named_struct('data', named_struct('stations', array({first}, {second})))"
    return station_status(spark, sf_dir).selectExpr(f"to_json({feed}) as value")


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC wall clock, so that results compare equal
    whatever the session time zone is."""
    return df.withColumns(
        {
            name: F.expr(f"timestampadd(MICROSECOND, unix_micros({name}), {_EPOCH})")
            for name, kind in df.dtypes
            if kind == "timestamp"
        }
    )
