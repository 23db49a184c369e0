"""Operators over free-bike reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.functions.flags import situation
from dockmetrics.functions.time import with_day, with_event_time
from dockmetrics.model import BIKE_SITUATION, BIKE_STATUS, require_columns
from dockmetrics.operators.dimension import fits_broadcast, join_stations
from dockmetrics.operators.keyed import latest_by_key, top_per_key
from dockmetrics.operators.rollup import rollup_by_time


def abandoned(bikes: DataFrame) -> DataFrame:
    """Reports of bikes left at no station: their station id is the empty string."""
    require_columns(bikes, ["station_id"])
    return bikes.filter(F.col("station_id") == "")


def abandoned_count(
    bikes: DataFrame, *, window: str | None = None, watermark: str | None = None
) -> DataFrame:
    """Abandoned bikes per reported second, or per tumbling ``window``."""
    timed = with_event_time(abandoned(bikes))
    if watermark:
        timed = timed.withWatermark("timestamp", watermark)
    counted = rollup_by_time(timed, window, F.count(F.lit(1)).alias("abandoned_bikes_count"))
    return with_day(counted).select(*BIKE_STATUS.columns)


def with_situation(bikes: DataFrame) -> DataFrame:
    """Add ``situation``: BOTH, RESERVED, DISABLED or null."""
    require_columns(bikes, ["is_reserved", "is_disabled"])
    return bikes.withColumn("situation", situation())


def bike_situation(bikes: DataFrame, stations: DataFrame) -> DataFrame:
    """Reports of reserved or disabled bikes with the name of their station.

    Bikes at no station or at one the dimension lacks are left out.
    """
    require_columns(bikes, ["bike_id", "station_id", "is_reserved", "is_disabled"])
    require_columns(stations, ["station_id", "station_name"])
    marked = with_situation(bikes.filter(F.col("is_reserved") | F.col("is_disabled")))
    named = join_stations(with_event_time(marked), stations.select("station_id", "station_name"))
    return named.select(*BIKE_SITUATION.columns)


def top_range(
    bikes: DataFrame, stations: DataFrame, k: int = 3, *, latest_per_bike: bool = True
) -> DataFrame:
    """The ``k`` reports with most range left, among bikes at a known station.

    ``latest_per_bike`` looks at each bike's last report only, so one bike cannot
    take two places. Equal ranges are ordered by bike id, then newest first,
    then by station id.
    Batch only: a stream calls it per micro-batch.
    """
    require_columns(bikes, ["bike_id", "station_id", "last_reported", "current_range_meters"])
    require_columns(stations, ["station_id", "station_name"])
    reports = bikes.select("bike_id", "station_id", "last_reported", "current_range_meters")
    if latest_per_bike:
        reports = latest_by_key(reports, ["bike_id"], ["last_reported", "current_range_meters"])
    best_first = [
        F.desc("current_range_meters"),
        F.asc("bike_id"),
        F.desc("last_reported"),
        F.asc("station_id"),
    ]
    stations = stations.select("station_id", "station_name")
    if not fits_broadcast(stations):
        # Whether a report counts depends on its station alone, so the k best of
        # each station are enough, and only they are shuffled for the join.
        reports = top_per_key(reports, ["station_id"], [*best_first], k)
    best = join_stations(reports, stations).orderBy(*best_first).limit(k)
    return with_event_time(best).select(
        "timestamp", "bike_id", "station_name", "current_range_meters"
    )
