"""Operators on hand-written frames."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from dockmetrics.operators import (
    abandoned,
    abandoned_count,
    bike_situation,
    daily_station_stats,
    network_status,
    profile,
    station_dimension,
    top_range,
)
from dockmetrics.operators.dimension import fits_broadcast, join_by_slot, join_stations

T0 = 1_704_067_200
STATUS = "station_id string, num_bikes_available int, num_docks_available int, last_reported int"
BIKES = (
    "bike_id string, station_id string, last_reported int, is_reserved boolean,"
    " is_disabled boolean, current_range_meters int"
)


@pytest.fixture
def dimension(spark, tmp_path):
    information = spark.createDataFrame(
        [("a", 10, "Alpha"), ("b", 10, "Beta"), ("z", 0, "Zero")],
        "station_id string, capacity int, name string",
    )
    station_dimension(information).write.parquet(f"{tmp_path}/dimension")
    return spark.read.parquet(f"{tmp_path}/dimension")


@pytest.fixture
def status(spark):
    return spark.createDataFrame(
        [
            ("a", 0, 10, T0),
            ("b", 7, 3, T0),
            ("a", 10, 0, T0 + 61),
            ("b", 6, 4, T0 + 61),
            ("z", 0, 0, T0 + 100),
            ("unknown", 5, 5, T0),
            (None, 5, 5, T0),
        ],
        STATUS,
    )


def seconds(df, *columns):
    return sorted(tuple(r) for r in df.select(F.unix_seconds("timestamp"), *columns).collect())


MEASURES = (
    "total_bikes_available",
    "total_docks_available",
    "empty_count",
    "full_count",
    "saturation_count",
)


def test_network_status_counts_known_stations_per_second(status, dimension):
    assert seconds(network_status(status, dimension), *MEASURES) == [
        (T0, 7, 13, 1, 0, 1),
        (T0 + 61, 16, 4, 0, 1, 1),
        (T0 + 100, 0, 0, 1, None, 1),
    ]


def test_network_status_by_window(status, dimension):
    rollup = network_status(status, dimension, window="1 minute")
    assert seconds(rollup, *MEASURES) == [
        (T0, 7, 13, 1, 0, 1),
        (T0 + 60, 16, 4, 1, 1, 2),
    ]
    assert {str(r.day) for r in rollup.collect()} == {"2024-01-01"}


def test_network_status_of_nothing(spark, dimension):
    assert network_status(spark.createDataFrame([], STATUS), dimension).count() == 0


def test_joins_agree_with_and_without_broadcast(spark, status, dimension, rows_of):
    assert fits_broadcast(dimension)
    expected = rows_of(network_status(status, dimension))
    joined = rows_of(join_stations(status, dimension))
    left = rows_of(join_stations(status, dimension, "left"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(dimension)
        assert rows_of(network_status(status, dimension)) == expected
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        slotted = join_stations(status, dimension)
        assert "_slot" in slotted._jdf.queryExecution().toString()
        assert rows_of(slotted) == joined
        assert rows_of(join_by_slot(status, dimension, "left", slots=3)) == left
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def bikes(spark):
    return spark.createDataFrame(
        [
            ("1", "a", T0, True, False, 900),
            ("2", "b", T0, False, True, 800),
            ("3", "a", T0, True, True, 800),
            ("4", "a", T0, False, False, 700),
            ("5", "", T0, True, True, 5000),
            ("6", "unknown", T0, True, False, 6000),
            ("7", "", T0 + 60, False, False, 100),
            ("1", "b", T0 + 60, None, False, 850),
            ("8", "a", T0, None, None, None),
        ],
        BIKES,
    )


def test_abandoned(bikes):
    assert sorted(r.bike_id for r in abandoned(bikes).collect()) == ["5", "7"]
    assert seconds(abandoned_count(bikes), "abandoned_bikes_count") == [(T0, 1), (T0 + 60, 1)]
    windowed = abandoned_count(bikes, window="5 minutes")
    assert seconds(windowed, "abandoned_bikes_count") == [(T0, 2)]


def test_bike_situation_leaves_out_bikes_at_no_known_station(bikes, dimension):
    out = bike_situation(bikes, dimension)
    assert out.columns == ["timestamp", "bike_id", "situation", "station_name"]
    assert seconds(out, "bike_id", "situation", "station_name") == [
        (T0, "1", "RESERVED", "Alpha"),
        (T0, "2", "DISABLED", "Beta"),
        (T0, "3", "BOTH", "Alpha"),
    ]


def ranked(df):
    return [(r.bike_id, r.station_name, r.current_range_meters) for r in df.collect()]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_top_range(spark, bikes, dimension, limit):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert ranked(top_range(bikes, dimension)) == [
            ("1", "Beta", 850),
            ("2", "Beta", 800),
            ("3", "Alpha", 800),
        ]
        assert ranked(top_range(bikes, dimension, latest_per_bike=False)) == [
            ("1", "Alpha", 900),
            ("1", "Beta", 850),
            ("2", "Beta", 800),
        ]
        assert len(ranked(top_range(bikes, dimension, 10))) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


COMPUTED = datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC)


def test_daily_station_stats(status, dimension):
    out = daily_station_stats(status, dimension, COMPUTED)
    rows = sorted(tuple(r)[:6] for r in out.collect())
    assert rows == [
        ("a", "Alpha", 5.0, 5.0, 1, 1),
        ("b", "Beta", 6.5, 3.5, 0, 0),
        ("unknown", None, 5.0, 5.0, 0, 0),
        ("z", "Zero", 0.0, 0.0, 1, 1),
    ]
    stamps = out.select(F.unix_micros("computation_timestamp")).distinct().collect()
    assert [s[0] for s in stamps] == [int(COMPUTED.timestamp()) * 1_000_000]
    assert dict(out.dtypes)["hour_avg_bikes_avail"] == "float"


def test_daily_computation_time_is_naive_utc_or_aware(spark, status, dimension):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        naive = daily_station_stats(status, dimension, COMPUTED.replace(tzinfo=None))
        stamp = naive.select(F.unix_seconds("computation_timestamp")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert stamp == int(COMPUTED.timestamp())


def test_daily_station_stats_by_hour(spark, dimension):
    history = spark.createDataFrame(
        [("a", 2, 8, T0), ("a", 4, 6, T0 + 60), ("a", 0, 10, T0 + 3600)], STATUS
    )
    out = daily_station_stats(history, dimension, COMPUTED, by_hour=True)
    rows = sorted((r.hour, r.hour_avg_bikes_avail, r.empty_occurrences_24h) for r in out.collect())
    assert rows == [(0, 3.0, 0), (1, 0.0, 1)]


def test_daily_needs_one_scan_and_one_shuffle(spark, tmp_path, status, dimension):
    status.write.parquet(f"{tmp_path}/h")
    out = daily_station_stats(spark.read.parquet(f"{tmp_path}/h"), dimension, COMPUTED)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # history and dimension
    assert plan.count("Exchange hashpartitioning") == 1
    read = "station_id:string,num_bikes_available:int,num_docks_available:int"
    assert f"ReadSchema: struct<{read}>" in plan


def test_profile(status, spark):
    assert tuple(profile(status).first()) == (7, T0, T0 + 100, 4)
    assert tuple(profile(spark.createDataFrame([], STATUS)).first()) == (0, None, None, 0)


@pytest.mark.parametrize(
    "call",
    [
        lambda df, dim: network_status(df, dim),
        lambda df, dim: bike_situation(df, dim),
        lambda df, dim: top_range(df, dim),
        lambda df, dim: daily_station_stats(df, dim, COMPUTED),
        lambda df, dim: station_dimension(df),
        lambda df, dim: abandoned_count(df),
        lambda df, dim: profile(df),
    ],
)
def test_operators_name_missing_columns(spark, dimension, call):
    with pytest.raises(ValueError, match="missing required columns"):
        call(spark.createDataFrame([(1,)], "other int"), dimension)
