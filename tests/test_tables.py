"""Keyed result tables on Parquet."""

from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockmetrics.model import (
    BIKE_SITUATION,
    BIKE_STATUS,
    RESULT_TABLES,
    STATION_DIMENSION,
    STATION_STATUS_WINDOWED,
)
from dockmetrics.plans import snapshot
from dockmetrics.session import shared_folder
from dockmetrics.sources import compact, ensure_tables, read_table, upsert
from dockmetrics.sources.tables import bases, next_run, partition_values, write_batch, writes

DDL = "station_id string, station_name string, capacity int"


def stations(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def names(spark, root):
    table = read_table(spark, root, STATION_DIMENSION)
    return {r.station_id: r.station_name for r in table.collect()}


def test_ensure_tables_creates_once_and_keeps_content(spark, tmp_path):
    root = str(tmp_path)
    ensure_tables(spark, root, RESULT_TABLES.values())
    for spec in RESULT_TABLES.values():
        table = read_table(spark, root, spec)
        assert table.columns == spec.columns and table.count() == 0
        assert [f.dataType for f in table.schema.fields] == [f.dataType for f in spec.schema.fields]
    upsert(stations(spark, ("a", "A", 1)), root, STATION_DIMENSION)
    ensure_tables(spark, root, RESULT_TABLES.values())
    assert names(spark, root) == {"a": "A"}


def test_table_never_written_reads_as_empty(spark, tmp_path):
    for spec in (STATION_DIMENSION, BIKE_SITUATION):
        assert read_table(spark, str(tmp_path), spec).count() == 0


def test_later_writes_win_and_repeating_one_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    write_batch(stations(spark, ("a", "A", 1), ("b", "B", 1)), root, STATION_DIMENSION, 1, 0)
    write_batch(stations(spark, ("a", "A2", 1)), root, STATION_DIMENSION, 1, 1)
    write_batch(stations(spark), root, STATION_DIMENSION, 1, 2)
    assert names(spark, root) == {"a": "A2", "b": "B"}
    write_batch(stations(spark, ("a", "A2", 1)), root, STATION_DIMENSION, 1, 1)
    assert names(spark, root) == {"a": "A2", "b": "B"}
    assert len(writes(spark, root, STATION_DIMENSION)) == 3


def test_a_new_run_is_later_though_its_batches_restart(spark, tmp_path):
    root = str(tmp_path)
    write_batch(stations(spark, ("a", "old", 1)), root, STATION_DIMENSION, 1, 11)
    run = next_run(spark, root, STATION_DIMENSION)
    write_batch(stations(spark, ("a", "new", 1)), root, STATION_DIMENSION, run, 0)
    assert run == 2 and names(spark, root) == {"a": "new"}


def test_batch_ids_are_compared_as_numbers(spark, tmp_path):
    root = str(tmp_path)
    for batch in (9, 10):
        write_batch(stations(spark, ("a", f"n{batch}", 1)), root, STATION_DIMENSION, 1, batch)
    assert names(spark, root) == {"a": "n10"}


def test_rows_with_null_keys_are_left_out(spark, tmp_path):
    upsert(stations(spark, (None, "x", 1), ("a", None, None)), str(tmp_path), STATION_DIMENSION)
    assert names(spark, str(tmp_path)) == {"a": None}


def test_unfinished_writes_do_not_count(spark, tmp_path):
    root = str(tmp_path)
    write_batch(stations(spark, ("a", "A", 1)), root, STATION_DIMENSION, 1, 0)
    write_batch(stations(spark, ("a", "half", 1)), root, STATION_DIMENSION, 1, 1)
    (Path(root) / "station_information/run=1/batch_id=1/_SUCCESS").unlink()
    assert names(spark, root) == {"a": "A"}


SITUATION = "timestamp int, bike_id string, situation string, station_name string"


def test_replace_table_shows_the_newest_write_only(spark, tmp_path):
    root = str(tmp_path)

    def put(batch, *bikes):
        rows = spark.createDataFrame([(0, b, "BOTH", "A") for b in bikes], SITUATION)
        rows = rows.withColumn("timestamp", F.timestamp_seconds("timestamp"))
        write_batch(rows, root, BIKE_SITUATION, 1, batch)

    def shown():
        return sorted(r.bike_id for r in read_table(spark, root, BIKE_SITUATION).collect())

    put(0, "1", "2", "2")
    assert shown() == ["1", "2"]
    put(1, "3")
    assert shown() == ["3"]
    put(1, "3")
    assert shown() == ["3"]
    put(2)
    assert shown() == []
    put(3, "4")
    compact(spark, root, BIKE_SITUATION)
    assert shown() == ["4"] and len(writes(spark, root, BIKE_SITUATION)) == 4
    compact(spark, root, BIKE_SITUATION, retain_seconds=0)
    assert shown() == ["4"] and len(writes(spark, root, BIKE_SITUATION)) == 1


def test_compact_keeps_content_and_later_writes_on_top(spark, tmp_path):
    root = str(tmp_path)

    def put(batch, *rows):
        write_batch(stations(spark, *rows), root, STATION_DIMENSION, 1, batch)

    put(0, ("a", "A", 1), ("b", "B", 1))
    put(1, ("a", "A1", 1))
    compact(spark, root, STATION_DIMENSION)
    assert names(spark, root) == {"a": "A1", "b": "B"}
    compact(spark, root, STATION_DIMENSION)
    assert len(bases(spark, root, STATION_DIMENSION)) == 1
    put(2, ("c", "C", 1))
    assert names(spark, root) == {"a": "A1", "b": "B", "c": "C"}
    # A write that is already folded in may be repeated after a restart.
    put(1, ("a", "A1", 1))
    assert names(spark, root) == {"a": "A1", "b": "B", "c": "C"}
    compact(spark, root, STATION_DIMENSION)
    assert [w.batch_id for w in writes(spark, root, STATION_DIMENSION)] == [0, 1, 2]
    compact(spark, root, STATION_DIMENSION, retain_seconds=0)
    assert writes(spark, root, STATION_DIMENSION) == []
    put(3, ("b", "B3", 1))
    compact(spark, root, STATION_DIMENSION)
    assert names(spark, root) == {"a": "A1", "b": "B3", "c": "C"}
    assert [b.batch_id for b in bases(spark, root, STATION_DIMENSION)] == [2, 3]
    assert next_run(spark, root, STATION_DIMENSION) == 2


def test_a_reader_survives_foldings(spark, tmp_path):
    root = str(tmp_path)
    put = lambda batch: write_batch(stations(spark, ("a", f"A{batch}", 1)), root, STATION_DIMENSION, 1, batch)
    put(0)
    held = read_table(spark, root, STATION_DIMENSION)
    for batch in range(1, 4):
        put(batch)
        compact(spark, root, STATION_DIMENSION)
    assert [r.station_name for r in held.collect()] == ["A0"]


def test_key_filters_reach_the_scan(spark, tmp_path):
    rows = spark.sql(
        "select date'2024-01-01' as day, timestamp_seconds(id) as timestamp, id as empty_count,"
        " id as saturation_count, id as full_count, id as total_docks_available,"
        " id as total_bikes_available from range(5)"
    )
    upsert(rows, str(tmp_path), STATION_STATUS_WINDOWED)
    table = read_table(spark, str(tmp_path), STATION_STATUS_WINDOWED).filter("day = '2024-01-01'")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert table.count() == 5


@settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.dictionaries(
        st.integers(0, 20),
        st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), max_size=3),
        min_size=1,
        max_size=3,
    )
)
def test_arrival_order_of_numbered_writes_does_not_matter(spark, batches):
    contents = []
    for order in (sorted(batches), sorted(batches, reverse=True)):
        root = shared_folder(spark, "order")
        for batch in order:
            rows = [(k, v, 1) for k, v in batches[batch]]
            write_batch(stations(spark, *rows), root, STATION_DIMENSION, 1, batch)
        contents.append(names(spark, root))
    assert contents[0] == contents[1]


def test_shared_folder_is_below_the_session_setting(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


@pytest.mark.parametrize("spec", RESULT_TABLES.values(), ids=lambda s: s.name)
def test_specs_have_a_mode(spec):
    assert spec.mode in ("merge", "replace")





def counts(spark, *rows):
    frame = spark.createDataFrame([(d, s, n) for d, s, n in rows], "day string, s long, n long")
    return frame.selectExpr(
        "cast(day as date) day", "timestamp_seconds(s) timestamp", "n as abandoned_bikes_count"
    )


def test_a_fold_leaves_the_files_of_untouched_days_alone(spark, tmp_path, rows_of):
    root = str(tmp_path)

    def put(batch, *rows):
        write_batch(counts(spark, *rows), root, BIKE_STATUS, 1, batch)

    def shown(values=None):
        table = read_table(spark, root, BIKE_STATUS, values)
        return rows_of(table.selectExpr("cast(day as string)", "unix_seconds(timestamp)", "abandoned_bikes_count"))

    def files(day):
        return {p: p.stat().st_mtime_ns for p in Path(root).glob(f"bike_status/base/*/*/day={day}/*.parquet")}

    put(0, ("2024-01-01", 1, 1), ("2024-01-02", 2, 2))
    compact(spark, root, BIKE_STATUS)
    before = files("2024-01-01")
    put(1, ("2024-01-02", 2, 20), ("2024-01-03", 3, 3))
    expected = [("2024-01-01", 1, 1), ("2024-01-02", 2, 20), ("2024-01-03", 3, 3)]
    assert shown() == expected
    compact(spark, root, BIKE_STATUS)
    assert files("2024-01-01") == before and len(before) == 1
    assert shown() == expected and shown(["2024-01-02"]) == expected[1:2] and shown([]) == []
    assert partition_values(spark, root, BIKE_STATUS) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    put(2, ("2024-01-03", 4, 4))
    compact(spark, root, BIKE_STATUS, retain_seconds=0)
    assert shown() == [*expected, ("2024-01-03", 4, 4)]
    assert writes(spark, root, BIKE_STATUS) == []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        assert len(files(day)) == 1
    put(3)
    compact(spark, root, BIKE_STATUS, retain_seconds=0)
    assert shown() == [*expected, ("2024-01-03", 4, 4)]
    assert next_run(spark, root, BIKE_STATUS) == 2


def test_snapshot_reads_the_newest_days_only(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"2024-01-{d:02d}", 86_400 * d + s, d) for d in range(1, 9) for s in range(20)]
    upsert(counts(spark, *rows), root, BIKE_STATUS)
    for old in Path(root).glob("bike_status/run=*/batch_id=*/day=2024-01-0[1-6]/*.parquet"):
        old.write_bytes(b"never read")
    head = snapshot(spark, root, ["bike_status"])["bike_status"].collect()
    assert [r.abandoned_bikes_count for r in head] == [8] * 20 + [7] * 10
    assert [r.timestamp for r in head] == sorted((r.timestamp for r in head), reverse=True)


def test_a_snapshot_lists_a_partitioned_table_once(spark, tmp_path, monkeypatch):
    from dockmetrics.sources import files, tables

    root = str(tmp_path)
    row = "day date, timestamp timestamp, abandoned_bikes_count long"
    for day in range(1, 6):
        rows = spark.sql(f"select date'2024-01-0{day}' as day, timestamp'2024-01-0{day} 10:00:00' as timestamp, {day}L as abandoned_bikes_count")
        upsert(spark.createDataFrame(rows.collect(), row), root, BIKE_STATUS)
    patterns = []
    monkeypatch.setattr(tables, "matching", lambda s, p: patterns.append(p) or files.matching(s, p))
    shown = snapshot(spark, root, [BIKE_STATUS.name], n=3)[BIKE_STATUS.name].collect()
    assert [r.abandoned_bikes_count for r in shown] == [5, 4, 3]
    assert len(patterns) == len(set(patterns)) == 4
