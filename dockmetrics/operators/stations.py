"""Station dimension, station flags and the network-wide status rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.functions.flags import NEARLY_FULL_MARGIN, empty_flag, full_flag, saturation_flag
from dockmetrics.functions.time import with_day, with_event_time
from dockmetrics.model import (
    ARRIVED,
    STATION_DIMENSION,
    STATION_INFORMATION_SCHEMA,
    STATION_STATUS_WINDOWED,
    require_columns,
)
from dockmetrics.operators.dimension import join_stations
from dockmetrics.operators.rollup import rollup_by_time


def station_dimension(information: DataFrame) -> DataFrame:
    """Station information records as rows of the station table.

    The order of arrival is passed on: it tells which record of a station counts.
    """
    require_columns(information, STATION_INFORMATION_SCHEMA.fieldNames())
    arrival = [c for c in information.columns if c == ARRIVED]
    renamed = information.withColumnRenamed("name", "station_name")
    return renamed.select(*STATION_DIMENSION.columns, *arrival)


def with_station_flags(df: DataFrame, margin: int = NEARLY_FULL_MARGIN) -> DataFrame:
    """Add ``is_full``, ``saturation`` and ``is_empty`` as 0/1."""
    require_columns(df, ["num_bikes_available", "capacity"])
    return df.withColumns(
        {
            "is_full": full_flag(),
            "saturation": saturation_flag(margin=margin),
            "is_empty": empty_flag(),
        }
    )


def network_status(
    status: DataFrame,
    stations: DataFrame,
    *,
    window: str | None = None,
    watermark: str | None = None,
    margin: int = NEARLY_FULL_MARGIN,
) -> DataFrame:
    """Totals over the stations that reported at the same second.

    ``window`` (such as ``"1 minute"``) groups by a tumbling window instead, shown
    by its start. ``watermark`` bounds the state of a streaming run. Stations not
    in the dimension do not count.
    """
    require_columns(status, ["station_id", "num_bikes_available", "num_docks_available"])
    require_columns(stations, ["station_id", "capacity"])
    timed = with_event_time(status)
    if watermark:
        timed = timed.withWatermark("timestamp", watermark)
    known = join_stations(timed, stations.select("station_id", "capacity"))
    return network_totals(known, window=window, margin=margin)


def network_totals(
    enriched: DataFrame,
    *,
    window: str | None = None,
    watermark: str | None = None,
    margin: int = NEARLY_FULL_MARGIN,
) -> DataFrame:
    """The totals of ``network_status`` over reports that carry ``timestamp`` and their
    station's ``capacity`` already."""
    require_columns(enriched, ["timestamp", "capacity", "num_bikes_available", "num_docks_available"])
    if watermark:
        enriched = enriched.withWatermark("timestamp", watermark)
    totals = rollup_by_time(
        with_station_flags(enriched, margin),
        window,
        F.sum("num_bikes_available").alias("total_bikes_available"),
        F.sum("num_docks_available").alias("total_docks_available"),
        F.sum("is_empty").alias("empty_count"),
        F.sum("is_full").alias("full_count"),
        F.sum("saturation").alias("saturation_count"),
    )
    return with_day(totals).select(*STATION_STATUS_WINDOWED.columns)
