"""Relational operators; each takes and returns DataFrames, batch or stream."""

from dockmetrics.operators.bikes import (
    abandoned,
    abandoned_count,
    bike_situation,
    top_range,
    with_situation,
)
from dockmetrics.operators.daily import daily_station_stats, profile
from dockmetrics.operators.dimension import fits_broadcast, join_stations
from dockmetrics.operators.keyed import latest_by_key, top_per_key
from dockmetrics.operators.stations import (
    network_status,
    network_totals,
    station_dimension,
    with_station_flags,
)

__all__ = [
    "abandoned",
    "abandoned_count",
    "bike_situation",
    "daily_station_stats",
    "fits_broadcast",
    "join_stations",
    "latest_by_key",
    "network_status",
    "network_totals",
    "profile",
    "station_dimension",
    "top_per_key",
    "top_range",
    "with_situation",
    "with_station_flags",
]
