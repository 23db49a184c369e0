"""Record schemas, result-table contracts and the guards built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Topic names, the array that holds the elements of each feed
# document, record schemas and result-table columns. They are a data contract
# with the feed publisher and with readers of the result tables.
STATION_STATUS = "station_status"
STATION_INFORMATION = "station_information"
FREE_BIKE_STATUS = "free_bike_status"

# Order in which a topic's records came in; no part of any result table.
ARRIVED = "_arrived"

FEED_ARRAYS = {
    STATION_INFORMATION: "stations",
    STATION_STATUS: "stations",
    FREE_BIKE_STATUS: "bikes",
}

STATION_STATUS_SCHEMA = _struct(
    station_id=T.StringType(),
    num_bikes_available=T.IntegerType(),
    num_docks_available=T.IntegerType(),
    last_reported=T.IntegerType(),
)

STATION_INFORMATION_SCHEMA = _struct(
    station_id=T.StringType(),
    capacity=T.IntegerType(),
    name=T.StringType(),
)

FREE_BIKE_STATUS_SCHEMA = _struct(
    bike_id=T.StringType(),
    station_id=T.StringType(),
    last_reported=T.IntegerType(),
    is_reserved=T.BooleanType(),
    is_disabled=T.BooleanType(),
    current_range_meters=T.IntegerType(),
)

RECORD_SCHEMAS = {
    STATION_STATUS: STATION_STATUS_SCHEMA,
    STATION_INFORMATION: STATION_INFORMATION_SCHEMA,
    FREE_BIKE_STATUS: FREE_BIKE_STATUS_SCHEMA,
}

HISTORY_SCHEMA = T.StructType(
    [
        *STATION_STATUS_SCHEMA.fields,
        *_struct(timestamp=T.TimestampType(), day=T.DateType(), hour=T.IntegerType()).fields,
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Contract of one result table.

    ``keys`` identify a row. ``order`` is the serving order, as (column,
    descending) pairs. A ``merge`` table keeps the last row written per key; a
    ``replace`` table shows only the rows of its newest write. ``version`` lists
    columns that break ties between rows of one key inside one write, greatest
    first; whatever is left is settled by the remaining columns. ``partition``
    names the key column by whose values a merge table is laid out.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[tuple[str, bool], ...]
    mode: str = "merge"
    version: tuple[str, ...] = ()
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def sort_columns(self) -> list:
        return [F.desc(c) if descending else F.asc(c) for c, descending in self.order]


STATION_STATUS_WINDOWED = TableSpec(
    name="station_status_windowed",
    schema=_struct(
        day=T.DateType(),
        timestamp=T.TimestampType(),
        empty_count=T.LongType(),
        saturation_count=T.LongType(),
        full_count=T.LongType(),
        total_docks_available=T.LongType(),
        total_bikes_available=T.LongType(),
    ),
    keys=("day", "timestamp"),
    order=(("day", True), ("timestamp", True)),
    partition="day",
)

STATION_DIMENSION = TableSpec(
    name="station_information",
    schema=_struct(
        station_id=T.StringType(),
        station_name=T.StringType(),
        capacity=T.IntegerType(),
    ),
    keys=("station_id",),
    order=(("station_id", False),),
)

BIKE_STATUS = TableSpec(
    name="bike_status",
    schema=_struct(
        day=T.DateType(),
        timestamp=T.TimestampType(),
        abandoned_bikes_count=T.LongType(),
    ),
    keys=("day", "timestamp"),
    order=(("day", True), ("timestamp", True)),
    partition="day",
)

BIKE_SITUATION = TableSpec(
    name="bike_situation",
    schema=_struct(
        timestamp=T.TimestampType(),
        bike_id=T.StringType(),
        situation=T.StringType(),
        station_name=T.StringType(),
    ),
    keys=("bike_id",),
    order=(("bike_id", False),),
    mode="replace",
    version=("timestamp",),
)

MOST_CHARGED_BIKES = TableSpec(
    name="most_charged_bikes",
    schema=_struct(
        timestamp=T.TimestampType(),
        bike_id=T.StringType(),
        station_name=T.StringType(),
    ),
    keys=("bike_id",),
    order=(("bike_id", False),),
    mode="replace",
    version=("timestamp",),
)

BATCH_STATION_STATUS = TableSpec(
    name="batch_station_status",
    schema=_struct(
        station_id=T.StringType(),
        station_name=T.StringType(),
        hour_avg_bikes_avail=T.FloatType(),
        hour_avg_docks_avail=T.FloatType(),
        empty_occurrences_24h=T.LongType(),
        full_occurrences_24h=T.LongType(),
        computation_timestamp=T.TimestampType(),
    ),
    keys=("station_id",),
    order=(("station_id", False),),
    version=("computation_timestamp",),
)

# In the order in which the serving page lists them.
RESULT_TABLES = {
    spec.name: spec
    for spec in (
        STATION_DIMENSION,
        STATION_STATUS_WINDOWED,
        MOST_CHARGED_BIKES,
        BIKE_SITUATION,
        BIKE_STATUS,
        BATCH_STATION_STATUS,
    )
}


def require_columns(df: DataFrame, columns) -> None:
    """Raise ValueError naming the columns ``df`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; got {df.columns}")


def conform(df: DataFrame, spec: TableSpec, *extra: str) -> DataFrame:
    """Exactly the contract's columns, in its order and with its types, and ``extra``."""
    require_columns(df, [*spec.columns, *extra])
    columns = (F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields)
    return df.select(*columns, *extra)
