"""Scalar expressions: time keys, flags, situation, rounding, headings."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from dockmetrics.functions import (
    column_label,
    display_round,
    table_label,
    with_day,
    with_event_time,
    with_partition_keys,
)
from dockmetrics.model import RESULT_TABLES, STATION_DIMENSION, conform, require_columns
from dockmetrics.operators import with_situation, with_station_flags

EDGES = [0, 1_704_067_199, 1_704_067_200, 1_706_399_999, -1]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partition_keys_are_utc_in_any_session_zone(spark, zone):
    df = spark.createDataFrame([(s,) for s in EDGES], "last_reported int")
    keyed = with_partition_keys(with_day(with_event_time(df)))
    actual = keyed.select(F.unix_seconds("timestamp"), F.col("day").cast("string"), "hour")
    expected = []
    for second in EDGES:
        moment = datetime.fromtimestamp(second, tz=UTC)
        expected.append((second, moment.date().isoformat(), moment.hour))
    assert [tuple(r) for r in actual.collect()] == expected


def test_event_time_of_missing_second_is_null(spark):
    df = spark.createDataFrame([(None,)], "last_reported int")
    row = with_partition_keys(with_event_time(df)).first()
    assert (row.timestamp, row.day, row.hour) == (None, None, None)


@pytest.mark.parametrize(
    ("bikes", "capacity", "full", "saturated", "empty"),
    [
        (0, 10, 0, 0, 1),
        (6, 10, 0, 0, 0),
        (7, 10, 0, 1, 0),
        (10, 10, 1, 1, 0),
        (0, 0, None, 1, 1),
        (2, 0, None, 1, 0),
        (3, None, None, None, 0),
        (None, 10, None, None, None),
    ],
)
def test_station_flags(spark, bikes, capacity, full, saturated, empty):
    df = spark.createDataFrame([(bikes, capacity)], "num_bikes_available int, capacity int")
    row = with_station_flags(df).first()
    assert (row.is_full, row.saturation, row.is_empty) == (full, saturated, empty)


def test_saturation_margin_is_a_parameter(spark):
    df = spark.createDataFrame([(9, 10), (8, 10)], "num_bikes_available int, capacity int")
    assert [r.saturation for r in with_station_flags(df, margin=1).collect()] == [1, 0]


def test_flags_work_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(0, 0)], "num_bikes_available int, capacity int")
        assert with_station_flags(df).first().is_full is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(
    ("reserved", "disabled", "expected"),
    [
        (True, True, "BOTH"),
        (True, False, "RESERVED"),
        (False, True, "DISABLED"),
        (False, False, None),
        (None, True, "DISABLED"),
        (True, None, "RESERVED"),
        (None, None, None),
    ],
)
def test_situation(spark, reserved, disabled, expected):
    df = spark.createDataFrame([(reserved, disabled)], "is_reserved boolean, is_disabled boolean")
    assert with_situation(df).first().situation == expected


def test_display_round_follows_the_binary_value_and_leaves_others(spark):
    values = [2.675, 0.125, 0.375, -1.005, 7.0, 3.14159]
    rows = [(i, v, "1.239") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v float, s string")
    shown = display_round(df).orderBy("i").collect()
    widened = [r.v for r in df.orderBy("i").collect()]
    assert [r.v for r in shown] == [round(v, 2) for v in widened]
    assert {r.s for r in shown} == {"1.239"}
    assert dict(display_round(df).dtypes) == {"i": "int", "v": "double", "s": "string"}


def test_labels():
    assert table_label("batch_station_status") == "Batch Station Status"
    assert column_label("station_id") == "Station_Id"
    assert column_label("empty_occurrences_24h") == "Empty_Occurrences_24h"


def test_required_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "capacity int")
    with pytest.raises(ValueError, match="num_bikes_available"):
        with_station_flags(df)
    with pytest.raises(ValueError, match="'b', 'c'"):
        require_columns(df, ["capacity", "b", "c"])


def test_conform_orders_and_casts(spark):
    ddl = "capacity long, station_name string, station_id string, z string"
    df = spark.createDataFrame([(5, "x", "1", "more")], ddl)
    out = conform(df, STATION_DIMENSION)
    assert out.schema.fieldNames() == STATION_DIMENSION.columns
    assert tuple(out.first()) == ("1", "x", 5)


def test_contracts_name_their_own_columns():
    for spec in RESULT_TABLES.values():
        named = {*spec.keys, *spec.version, *(c for c, _ in spec.order)}
        assert named <= set(spec.columns)
