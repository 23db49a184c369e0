"""Per-station daily figures and a summary of the loaded history."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmetrics.functions.time import utc_hour, with_event_time
from dockmetrics.model import BATCH_STATION_STATUS, require_columns
from dockmetrics.operators.dimension import join_stations

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def _instant(moment: datetime) -> Column:
    """A timestamp literal; a naive ``moment`` is taken as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    return F.timestamp_micros(F.lit((aware - _EPOCH) // timedelta(microseconds=1)))


def daily_station_stats(
    history: DataFrame, stations: DataFrame, computed_at: datetime, *, by_hour: bool = False
) -> DataFrame:
    """Mean bikes and docks, and how often a station had no bike or no free dock.

    All figures come from one conditional aggregate, so the history is scanned
    once and only one partial row per station and task is shuffled. Means are
    over the whole selection; ``by_hour`` adds ``hour`` to the key. Here *full*
    means no free docks, whatever the capacity. Stations the dimension lacks
    keep a null name; rows without a station id are dropped.
    """
    require_columns(history, ["station_id", "num_bikes_available", "num_docks_available"])
    require_columns(stations, ["station_id", "station_name"])
    keys = ["station_id"]
    if by_hour:
        keys.append("hour")
        if "hour" not in history.columns:
            history = with_event_time(history).withColumn("hour", utc_hour("timestamp"))
    figures = (
        history.filter(F.col("station_id").isNotNull())
        .groupBy(*keys)
        .agg(
            F.avg("num_bikes_available").cast("float").alias("hour_avg_bikes_avail"),
            F.avg("num_docks_available").cast("float").alias("hour_avg_docks_avail"),
            F.count_if(F.col("num_bikes_available") == 0).alias("empty_occurrences_24h"),
            F.count_if(F.col("num_docks_available") == 0).alias("full_occurrences_24h"),
        )
    )
    return named_figures(figures, stations, computed_at, by_hour=by_hour)


def named_figures(
    figures: DataFrame, stations: DataFrame, computed_at: datetime, *, by_hour: bool = False
) -> DataFrame:
    """Figures per station in the form of the result table: with name and computation time."""
    figures = figures.withColumn("computation_timestamp", _instant(computed_at))
    named = join_stations(figures, stations.select("station_id", "station_name"), "left")
    extra = ["hour"] if by_hour else []
    return named.select(*BATCH_STATION_STATUS.columns, *extra)


def profile(history: DataFrame) -> DataFrame:
    """One row: row count, first and last event second, number of stations."""
    require_columns(history, ["station_id", "last_reported"])
    return history.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("last_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
        F.count_distinct("station_id").alias("station_count"),
    )
