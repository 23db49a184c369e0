"""Whole jobs: documents to topics, the six queries, daily figures, snapshot."""

import json
import logging
import threading
import time
from dataclasses import replace
from datetime import UTC, datetime
from pathlib import Path

import pytest

from dockmetrics.__main__ import main
from dockmetrics.model import (
    BATCH_STATION_STATUS,
    FREE_BIKE_STATUS,
    RESULT_TABLES,
    STATION_DIMENSION,
    STATION_INFORMATION,
    STATION_STATUS,
)
from dockmetrics.plans import (
    StreamConf,
    keep_running,
    preview,
    register_views,
    run_daily_job,
    run_ingest_job,
    run_stream_job,
    snapshot,
    wait,
)
from dockmetrics.sources import SourceConf, read_history, read_table, upsert

T0 = 1_704_067_200
COMPUTED = datetime(2024, 1, 2, tzinfo=UTC)

DOCUMENTS = {
    STATION_INFORMATION: [
        {"stations": [{"station_id": "a", "name": "Alpha", "capacity": 10, "lat": 48.4}]},
        {"stations": [{"station_id": "b", "name": "Beta", "capacity": 20, "lat": 48.3}]},
    ],
    STATION_STATUS: [
        {
            "stations": [
                {
                    "station_id": s,
                    "num_bikes_available": n,
                    "num_docks_available": d,
                    "last_reported": T0 + 60 * poll,
                }
                for s, n, d in (("a", 10 - poll, poll), ("b", 0, 20), ("new", 1, 1))
            ]
        }
        for poll in range(3)
    ],
    FREE_BIKE_STATUS: [
        {
            "bikes": [
                {
                    "bike_id": str(i),
                    "station_id": ("a", "b", "")[i % 3],
                    "last_reported": T0,
                    "is_reserved": i % 2 == 0,
                    "is_disabled": i == 4,
                    "current_range_meters": 100 * i,
                }
                for i in range(7)
            ]
        }
    ],
}


@pytest.fixture
def documents(tmp_path):
    for topic, contents in DOCUMENTS.items():
        folder = tmp_path / "documents" / topic
        folder.mkdir(parents=True)
        for i, data in enumerate(contents):
            (folder / f"{i}.json").write_text(json.dumps({"ttl": 60, "data": data}, indent=2))
        (folder / "junk.json").write_text("<html>service unavailable</html>")
    return SourceConf("documents", f"{tmp_path}/documents")


@pytest.fixture
def topics(spark, tmp_path, documents):
    source = SourceConf("files", f"{tmp_path}/topics")
    queries = run_ingest_job(spark, documents, source, f"{tmp_path}/ck-ingest", available_now=True)
    wait(queries)
    return source


def stream_conf(tmp_path, source):
    return StreamConf(
        source=source,
        root=f"{tmp_path}/tables",
        history_path=f"{tmp_path}/history",
        checkpoints=f"{tmp_path}/ck",
        available_now=True,
    )


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("through_topics", [True, False], ids=["topics", "documents"])
def test_documents_to_snapshot(spark, tmp_path, request, through_topics):
    source = request.getfixturevalue("topics" if through_topics else "documents")
    conf = stream_conf(tmp_path, source)
    queries = run_stream_job(spark, conf)
    assert len(queries) == 6
    wait(queries)

    def table(name):
        return read_table(spark, conf.root, RESULT_TABLES[name])

    assert values(table("station_information"), "station_id", "station_name", "capacity") == [
        ("a", "Alpha", 10),
        ("b", "Beta", 20),
    ]
    rollup = table("station_status_windowed").selectExpr(
        "unix_seconds(timestamp)",
        "total_bikes_available",
        "total_docks_available",
        "empty_count",
        "full_count",
        "saturation_count",
    )
    assert sorted(map(tuple, rollup.collect())) == [
        (T0, 10, 20, 1, 1, 1),
        (T0 + 60, 9, 21, 1, 0, 1),
        (T0 + 120, 8, 22, 1, 0, 1),
    ]
    assert values(table("bike_status"), "abandoned_bikes_count") == [(2,)]
    assert values(table("bike_situation"), "bike_id", "situation", "station_name") == [
        ("0", "RESERVED", "Alpha"),
        ("4", "BOTH", "Beta"),
        ("6", "RESERVED", "Alpha"),
    ]
    assert values(table("most_charged_bikes"), "bike_id") == [("3",), ("4",), ("6",)]
    assert read_history(spark, conf.history_path).count() == 9

    run = run_daily_job(
        spark,
        "2024-01-01",
        root=conf.root,
        history_path=conf.history_path,
        computed_at=COMPUTED,
    )
    assert (run.row_count, run.first_reported, run.last_reported) == (9, T0, T0 + 120)
    assert values(table("batch_station_status"), *BATCH_STATION_STATUS.columns[:6]) == [
        ("a", "Alpha", 9.0, 1.0, 0, 1),
        ("b", "Beta", 0.0, 20.0, 3, 0),
        ("new", None, 1.0, 1.0, 0, 0),
    ]

    shown = snapshot(spark, conf.root)
    assert list(shown) == list(RESULT_TABLES)
    newest = shown["station_status_windowed"].selectExpr("unix_seconds(timestamp) as s").collect()
    assert [r.s for r in newest] == [T0 + 120, T0 + 60, T0]


def test_stream_job_goes_on_with_new_stations_after_a_restart(spark, tmp_path, land):
    source = SourceConf("files", f"{tmp_path}/landing")
    conf = stream_conf(tmp_path, source)

    def status(station, second):
        return {
            "station_id": station,
            "num_bikes_available": 1,
            "num_docks_available": 1,
            "last_reported": second,
        }

    land(STATION_INFORMATION, [{"station_id": "a", "name": "A", "capacity": 1}])
    land(STATION_STATUS, [status("a", T0), status("new", T0)])
    land(FREE_BIKE_STATUS, ["junk"])
    wait(run_stream_job(spark, conf))
    land(STATION_INFORMATION, [{"station_id": "new", "name": "N", "capacity": 9}])
    land(STATION_STATUS, [status("a", T0 + 60), status("new", T0 + 60)])
    wait(run_stream_job(spark, conf))
    rollup = read_table(spark, conf.root, RESULT_TABLES["station_status_windowed"])
    assert values(rollup.selectExpr("unix_seconds(timestamp) s", "total_bikes_available"), "*") == [
        (T0, 1),
        (T0 + 60, 2),
    ]
    assert read_history(spark, conf.history_path).count() == 4


def test_stream_job_may_start_before_anything_landed(spark, tmp_path):
    conf = stream_conf(tmp_path, SourceConf("files", f"{tmp_path}/nothing-yet"))
    wait(run_stream_job(spark, conf))
    for frame in snapshot(spark, conf.root).values():
        assert frame.count() == 0
    assert read_history(spark, conf.history_path).count() == 0


def test_stream_job_runs_on_triggers_until_stopped(spark, tmp_path, documents):
    conf = stream_conf(tmp_path, documents)
    conf = replace(conf, available_now=False, trigger="1 second", history_trigger="1 second")
    queries = run_stream_job(spark, conf)
    try:
        assert all(query.isActive for query in queries.values())
        for query in queries.values():
            query.processAllAvailable()
    finally:
        for query in queries.values():
            query.stop()
    assert read_table(spark, conf.root, RESULT_TABLES["bike_situation"]).count() == 3


def test_new_stations_join_the_rollup_while_it_runs(spark, tmp_path, land):
    conf = replace(
        stream_conf(tmp_path, SourceConf("files", f"{tmp_path}/landing")),
        available_now=False,
        trigger="500 milliseconds",
        history_trigger="500 milliseconds",
    )

    def status(station, second):
        figures = {"num_bikes_available": 1, "num_docks_available": 1}
        return {"station_id": station, "last_reported": second, **figures}

    land(STATION_INFORMATION, [{"station_id": "a", "name": "A", "capacity": 1}])
    land(STATION_STATUS, [status("a", T0), status("b", T0)])
    land(FREE_BIKE_STATUS, ["junk"])
    queries = run_stream_job(spark, conf)
    first = queries["station_status"]
    first.processAllAvailable()
    failures = []

    def supervise():
        try:
            keep_running(spark, conf, queries, check_seconds=1)
        except Exception as error:
            failures.append(error)

    supervisor = threading.Thread(target=supervise)
    supervisor.start()
    try:
        land(STATION_INFORMATION, [{"station_id": "b", "name": "B", "capacity": 9}])
        for _ in range(120):
            if queries["station_status"] is not first:
                break
            time.sleep(0.5)
        land(STATION_STATUS, [status("a", T0 + 60), status("b", T0 + 60)])
        queries["station_status"].processAllAvailable()
    finally:
        queries["history"].stop()
        supervisor.join(120)
    assert not failures and not any(query.isActive for query in queries.values())
    rollup = read_table(spark, conf.root, RESULT_TABLES["station_status_windowed"])
    assert values(rollup.selectExpr("unix_seconds(timestamp) s", "total_bikes_available"), "*") == [
        (T0, 1),
        (T0 + 60, 2),
    ]


def test_daily_job_without_history_writes_nothing(spark, tmp_path):
    run = run_daily_job(
        spark,
        "2024-01-01",
        root=f"{tmp_path}/tables",
        history_path=f"{tmp_path}/none",
        computed_at=COMPUTED,
    )
    assert run.row_count == 0 and not Path(f"{tmp_path}/tables").exists()


@pytest.mark.parametrize(
    "when",
    [
        {"day": "40"},
        {"day": "abc"},
        {"day_of_month": 40},
        {},
        {"day": "2024-01-01", "day_of_month": 1},
    ],
)
def test_daily_job_refuses_what_is_no_day(spark, when):
    with pytest.raises(ValueError):
        run_daily_job(spark, root="r", history_path="h", computed_at=COMPUTED, **when)


def test_preview(spark):
    assert len(preview(spark.range(100))) == 5


def test_snapshot_orders_limits_labels_and_skips(spark, tmp_path, caplog):
    root = str(tmp_path)
    rows = [(f"{i:02d}", f"S{i}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "station_id string, station_name string, capacity int")
    upsert(df, root, STATION_DIMENSION)
    shown = snapshot(spark, root, ["station_information", "no_such_table"], labels=True)
    assert list(shown) == ["Station Information"]
    head = shown["Station Information"]
    assert head.columns == ["Station_Id", "Station_Name", "Capacity"]
    assert [r[0] for r in head.collect()] == [f"{i:02d}" for i in range(30)]
    assert "no_such_table" in caplog.text
    assert snapshot(spark, root, ["station_information"], n=3)["station_information"].count() == 3


def test_result_tables_as_views(spark, tmp_path):
    df = spark.createDataFrame([("a", "A", 1)], STATION_DIMENSION.schema)
    upsert(df, str(tmp_path), STATION_DIMENSION)
    assert register_views(spark, str(tmp_path)) == list(RESULT_TABLES)
    assert spark.sql("SELECT * FROM station_information LIMIT 30").count() == 1
    assert spark.sql("SELECT * FROM bike_status LIMIT 30").count() == 0


def test_snapshot_rounds_fractions(spark, tmp_path):
    figures = spark.sql(
        "select 'a' station_id, 'A' station_name, cast(1.2345 as float) hour_avg_bikes_avail,"
        " cast(0.125 as float) hour_avg_docks_avail, 1 empty_occurrences_24h,"
        " 2 full_occurrences_24h, timestamp_seconds(0) computation_timestamp"
    )
    upsert(figures, str(tmp_path), BATCH_STATION_STATUS)
    row = snapshot(spark, str(tmp_path), ["batch_station_status"])["batch_station_status"].first()
    assert (row.hour_avg_bikes_avail, row.hour_avg_docks_avail) == (1.23, 0.12)


def test_command_line(spark, tmp_path, documents, capsys, caplog):
    caplog.set_level(logging.INFO, logger="dockmetrics")
    root, history = f"{tmp_path}/tables", f"{tmp_path}/history"
    stream = ["stream", "--source", "documents", "--location", documents.location]
    stream += ["--root", root, "--history", history]
    stream += ["--checkpoints", f"{tmp_path}/ck", "--available-now"]
    assert main(stream) == 0
    daily = ["--root", root, "--history", history]
    assert main(["daily", "2024-01-01", *daily]) == 0
    assert main(["daily", "2024-01-02", *daily]) == 1
    assert main(["daily", "--day-of-month", "1", *daily]) == 0
    for wrong in (["27"], ["--day-of-month", "32"], []):
        with pytest.raises(SystemExit):
            main(["daily", *wrong, *daily])
    assert main(["snapshot", "--root", root]) == 0
    printed = capsys.readouterr().out
    # Three documents and a page of junk were read for nine status records.
    assert "'station_status messages': {'rows': 9}" in caplog.text
    assert "figures of 2024-01-01 written" in caplog.text
    assert "Batch Station Status" in printed and "Empty_Occurrences_24h" in printed
