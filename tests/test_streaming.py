"""Streams against batch, late data, restarts, replays and snapshots."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dockmetrics.model import (
    BIKE_SITUATION,
    BIKE_STATUS,
    FREE_BIKE_STATUS,
    FREE_BIKE_STATUS_SCHEMA,
    MOST_CHARGED_BIKES,
    STATION_DIMENSION,
    STATION_INFORMATION,
    STATION_INFORMATION_SCHEMA,
    STATION_STATUS,
    STATION_STATUS_SCHEMA,
    STATION_STATUS_WINDOWED,
)
from dockmetrics.operators import (
    abandoned_count,
    bike_situation,
    network_status,
    station_dimension,
    top_range,
)
from dockmetrics.sources import SourceConf, decode, read_history, read_table, read_topic
from dockmetrics.sources.tables import bases, writes
from dockmetrics.streaming import history_sink, replace_sink, upsert_sink

T0 = 1_704_067_200
SCHEMAS = {
    STATION_STATUS: STATION_STATUS_SCHEMA,
    STATION_INFORMATION: STATION_INFORMATION_SCHEMA,
    FREE_BIKE_STATUS: FREE_BIKE_STATUS_SCHEMA,
}


@pytest.fixture
def stream(spark, tmp_path):
    """A topic as typed stream, one file per micro-batch."""

    def open_topic(topic, per_trigger=1):
        conf = SourceConf("files", f"{tmp_path}/landing", per_trigger=per_trigger)
        return decode(read_topic(spark, conf, topic), SCHEMAS[topic])

    return open_topic


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.fixture
def dimension(spark, tmp_path):
    rows = [("a", "Alpha", 10), ("b", "Beta", 10)]
    df = spark.createDataFrame(rows, "station_id string, station_name string, capacity int")
    df.write.parquet(f"{tmp_path}/dimension")
    return spark.read.parquet(f"{tmp_path}/dimension")


def report(station, bikes, second):
    return {
        "station_id": station,
        "num_bikes_available": bikes,
        "num_docks_available": 10 - bikes,
        "last_reported": second,
    }


def bike(number, station, second, reach=100, reserved=False, disabled=False):
    return {
        "bike_id": number,
        "station_id": station,
        "last_reported": second,
        "is_reserved": reserved,
        "is_disabled": disabled,
        "current_range_meters": reach,
    }


def totals(spark, root):
    table = read_table(spark, root, STATION_STATUS_WINDOWED)
    shown = table.select(F.unix_seconds("timestamp"), "total_bikes_available")
    return sorted(tuple(r) for r in shown.collect())


def test_update_stream_equals_batch(spark, tmp_path, land, stream, dimension, rows_of):
    files = [
        [report("a", 0, T0), report("b", 3, T0 + 60)],
        [report("b", 7, T0), "junk", report("unknown", 1, T0)],
        [report("a", 10, T0 + 60), report("a", 1, T0 + 120)],
    ]
    for records in files:
        land(STATION_STATUS, records)
    root = f"{tmp_path}/tables"
    drain(
        upsert_sink(
            network_status(stream(STATION_STATUS), dimension, watermark="10 minutes"),
            root,
            STATION_STATUS_WINDOWED,
            f"{tmp_path}/ck",
        )
    )
    status = decode(spark.read.text(f"{tmp_path}/landing/{STATION_STATUS}"), STATION_STATUS_SCHEMA)
    expected = rows_of(network_status(status, dimension))
    assert rows_of(read_table(spark, root, STATION_STATUS_WINDOWED)) == expected
    done = writes(spark, root, STATION_STATUS_WINDOWED)
    assert len(expected) == 3 and len(done) >= 3
    # Four state partitions, but the rows of a batch are gathered.
    files = [len(list(day.glob("*.parquet"))) for w in done for day in Path(w.path.removeprefix("file:")).glob("day=*")]
    assert set(files) == {1}


def test_stream_with_a_dimension_too_large_to_broadcast(
    spark, tmp_path, land, stream, dimension, rows_of
):
    land(STATION_STATUS, [report("a", i % 11, T0 + i % 3) for i in range(50)])
    land(STATION_STATUS, [report("b", 5, T0 + 1), report("unknown", 5, T0)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rollup = network_status(stream(STATION_STATUS), dimension, watermark="10 minutes")
        assert "_slot" in rollup._jdf.queryExecution().toString()
        drain(upsert_sink(rollup, str(tmp_path), STATION_STATUS_WINDOWED, f"{tmp_path}/ck"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    status = decode(spark.read.text(f"{tmp_path}/landing/{STATION_STATUS}"), STATION_STATUS_SCHEMA)
    expected = rows_of(network_status(status, dimension))
    assert rows_of(read_table(spark, str(tmp_path), STATION_STATUS_WINDOWED)) == expected


def test_windowed_stream_equals_batch(spark, tmp_path, land, stream, dimension, rows_of):
    land(STATION_STATUS, [report("a", 1, T0 + 1), report("b", 2, T0 + 59)])
    land(STATION_STATUS, [report("a", 3, T0 + 30), report("b", 4, T0 + 60)])
    drain(
        upsert_sink(
            network_status(
                stream(STATION_STATUS), dimension, window="1 minute", watermark="10 minutes"
            ),
            str(tmp_path),
            STATION_STATUS_WINDOWED,
            f"{tmp_path}/ck",
        )
    )
    assert totals(spark, str(tmp_path)) == [(T0, 6), (T0 + 60, 4)]


def test_late_rows_are_dropped_one_batch_after_the_watermark_moved(
    spark, tmp_path, land, stream, dimension
):
    land(STATION_STATUS, [report("a", 1, T0)])
    land(STATION_STATUS, [report("a", 2, T0 + 3600)])
    land(STATION_STATUS, [report("a", 4, T0 + 1)])
    land(STATION_STATUS, [report("a", 8, T0 + 2), report("b", 3, T0 + 3600)])
    drain(
        upsert_sink(
            network_status(stream(STATION_STATUS), dimension, watermark="10 minutes"),
            str(tmp_path),
            STATION_STATUS_WINDOWED,
            f"{tmp_path}/ck",
        )
    )
    assert totals(spark, str(tmp_path)) == [(T0, 1), (T0 + 1, 4), (T0 + 3600, 5)]


def test_abandoned_stream(spark, tmp_path, land, stream):
    land(FREE_BIKE_STATUS, [bike("1", "", T0), bike("2", "a", T0)])
    land(FREE_BIKE_STATUS, [bike("3", "", T0), bike("4", "", T0 + 60)])
    drain(
        upsert_sink(
            abandoned_count(stream(FREE_BIKE_STATUS), watermark="10 minutes"),
            str(tmp_path),
            BIKE_STATUS,
            f"{tmp_path}/ck",
        )
    )
    table = read_table(spark, str(tmp_path), BIKE_STATUS)
    counts = table.select(F.unix_seconds("timestamp"), "abandoned_bikes_count").collect()
    assert sorted(map(tuple, counts)) == [(T0, 2), (T0 + 60, 1)]


def test_restart_continues_rollup_and_history_without_duplicates(
    spark, tmp_path, land, stream, dimension
):
    root = f"{tmp_path}/tables"

    def run():
        drain(
            upsert_sink(
                network_status(stream(STATION_STATUS), dimension, watermark="10 minutes"),
                root,
                STATION_STATUS_WINDOWED,
                f"{tmp_path}/ck1",
            )
        )
        drain(history_sink(stream(STATION_STATUS), f"{tmp_path}/history", f"{tmp_path}/ck2"))

    land(STATION_STATUS, [report("a", 1, T0), report("b", 2, T0 + 60)])
    run()
    land(STATION_STATUS, [report("b", 4, T0), report("a", 1, T0 + 86_400)])
    run()
    run()
    assert totals(spark, root) == [(T0, 5), (T0 + 60, 2), (T0 + 86_400, 1)]
    assert {w.run for w in writes(spark, root, STATION_STATUS_WINDOWED)} == {1}
    history = read_history(spark, f"{tmp_path}/history")
    assert history.count() == 4
    assert read_history(spark, f"{tmp_path}/history", "2024-01-02").count() == 1


def test_a_new_checkpoint_starts_a_later_run(spark, tmp_path, land, stream):
    def run(checkpoint):
        information = station_dimension(stream(STATION_INFORMATION))
        path = f"{tmp_path}/{checkpoint}"
        drain(upsert_sink(information, str(tmp_path), STATION_DIMENSION, path))

    land(STATION_INFORMATION, [{"station_id": "a", "name": "Old", "capacity": 1}])
    land(STATION_INFORMATION, [{"station_id": "a", "name": "New", "capacity": 2}, "junk"])
    run("ck1")
    run("ck2")
    table = read_table(spark, str(tmp_path), STATION_DIMENSION)
    assert [tuple(r) for r in table.collect()] == [("a", "New", 2)]
    assert {w.run for w in writes(spark, str(tmp_path), STATION_DIMENSION)} == {1, 2}


@pytest.mark.parametrize("kind", ["files", "documents"])
def test_last_announcement_of_a_station_counts_within_a_batch(spark, tmp_path, land, kind):
    for name in ("Zoo", "Old Zoo", "Animal Park"):
        record = {"station_id": "a", "name": name, "capacity": 1}
        if kind == "documents":
            record = {"data": {"stations": [record]}}
        land(STATION_INFORMATION, [record])
    records = read_topic(spark, SourceConf(kind, f"{tmp_path}/landing"), STATION_INFORMATION)
    information = station_dimension(decode(records, STATION_INFORMATION_SCHEMA))
    drain(upsert_sink(information, str(tmp_path), STATION_DIMENSION, f"{tmp_path}/ck"))
    table = read_table(spark, str(tmp_path), STATION_DIMENSION)
    assert table.columns == STATION_DIMENSION.columns
    assert [r.station_name for r in table.collect()] == ["Animal Park"]
    assert len(writes(spark, str(tmp_path), STATION_DIMENSION)) == 1


def test_replayed_batch_adds_nothing(spark, tmp_path, land, stream, dimension):
    """Forget that the last batch was committed: it is run again."""
    land(STATION_STATUS, [report("a", 1, T0)])
    land(STATION_STATUS, [report("b", 2, T0), report("a", 3, T0 + 60)])

    def run():
        drain(
            upsert_sink(
                network_status(stream(STATION_STATUS), dimension, watermark="10 minutes"),
                str(tmp_path),
                STATION_STATUS_WINDOWED,
                f"{tmp_path}/ck",
            )
        )

    run()
    before = totals(spark, str(tmp_path))
    commits = sorted(
        (p for p in Path(f"{tmp_path}/ck/commits").iterdir() if p.name.isdigit()),
        key=lambda p: int(p.name),
    )
    commits[-1].unlink()
    checksum = commits[-1].with_name(f".{commits[-1].name}.crc")
    if checksum.exists():
        checksum.unlink()
    run()
    assert totals(spark, str(tmp_path)) == before == [(T0, 3), (T0 + 60, 3)]


def test_sink_folds_its_table_now_and_then(spark, tmp_path, land, stream):
    for i in range(5):
        land(STATION_INFORMATION, [{"station_id": "a", "name": f"N{i}", "capacity": i}])
    drain(
        upsert_sink(
            station_dimension(stream(STATION_INFORMATION)),
            str(tmp_path),
            STATION_DIMENSION,
            f"{tmp_path}/ck",
            output_mode="append",
            compact_every=2,
        )
    )
    root = str(tmp_path)
    assert [b.batch_id for b in bases(spark, root, STATION_DIMENSION)] == [1, 3]
    # what the first fold covers stays for readers that listed it
    assert [w.batch_id for w in writes(spark, root, STATION_DIMENSION)] == [0, 1, 2, 3, 4]
    assert tuple(read_table(spark, root, STATION_DIMENSION).first()) == ("a", "N4", 4)


def test_bike_situation_is_replaced_by_every_batch(spark, tmp_path, land, stream, dimension):
    def run():
        drain(
            replace_sink(
                stream(FREE_BIKE_STATUS),
                str(tmp_path),
                BIKE_SITUATION,
                f"{tmp_path}/ck",
                prepare=lambda batch: bike_situation(batch, dimension),
            )
        )

    def shown():
        rows = read_table(spark, str(tmp_path), BIKE_SITUATION).collect()
        return sorted((r.bike_id, r.situation) for r in rows)

    land(FREE_BIKE_STATUS, [bike("1", "a", T0, reserved=True), bike("2", "b", T0, disabled=True)])
    run()
    assert shown() == [("1", "RESERVED"), ("2", "DISABLED")]
    land(
        FREE_BIKE_STATUS,
        [
            bike("3", "b", T0 + 60, reserved=True),
            bike("3", "a", T0 + 61, reserved=True, disabled=True),
            bike("4", "", T0 + 60, reserved=True),
        ],
    )
    run()
    assert shown() == [("3", "BOTH")]
    land(FREE_BIKE_STATUS, [bike("1", "a", T0 + 120)])
    run()
    assert shown() == []


def test_most_charged_bikes_of_the_latest_batch(spark, tmp_path, land, stream, dimension):
    land(FREE_BIKE_STATUS, [bike("9", "a", T0, 9_999)])
    land(
        FREE_BIKE_STATUS,
        [bike(str(i), "a" if i % 2 else "b", T0 + 60, 100 * i) for i in range(1, 6)]
        + [bike("5", "a", T0 + 60, 500), bike("6", "", T0 + 60, 900)],
    )
    drain(
        replace_sink(
            stream(FREE_BIKE_STATUS),
            str(tmp_path),
            MOST_CHARGED_BIKES,
            f"{tmp_path}/ck",
            prepare=lambda batch: top_range(batch, dimension),
        )
    )
    rows = read_table(spark, str(tmp_path), MOST_CHARGED_BIKES).collect()
    assert sorted((r.bike_id, r.station_name) for r in rows) == [
        ("3", "Alpha"),
        ("4", "Beta"),
        ("5", "Alpha"),
    ]


def test_only_replace_tables_can_be_replaced(tmp_path, land, stream):
    land(STATION_INFORMATION, [])
    with pytest.raises(ValueError, match="not a replace table"):
        replace_sink(
            stream(STATION_INFORMATION), str(tmp_path), STATION_DIMENSION, f"{tmp_path}/ck"
        )


def test_rebalanced_history_keeps_all_rows(spark, tmp_path, land, stream):
    for i in range(3):
        land(STATION_STATUS, [report("a", i, T0 + i * 3600), report("b", i, T0 + i)])
    status = stream(STATION_STATUS, per_trigger=None)
    drain(history_sink(status, f"{tmp_path}/history", f"{tmp_path}/ck", rebalance=True))
    history = read_history(spark, f"{tmp_path}/history")
    assert history.count() == 6
    assert sorted(r.hour for r in history.collect()) == [0, 0, 0, 0, 1, 2]
    assert sum("/hour=0/" in f for f in history.inputFiles()) == 1


def test_checkpoint_and_table_run_are_discarded_together(spark, tmp_path, land, stream):
    land(STATION_INFORMATION, [{"station_id": "a", "name": "A", "capacity": 1}])

    def run():
        information = station_dimension(stream(STATION_INFORMATION))
        drain(upsert_sink(information, str(tmp_path), STATION_DIMENSION, f"{tmp_path}/ck"))

    run()
    shutil.rmtree(f"{tmp_path}/ck")
    land(STATION_INFORMATION, [{"station_id": "a", "name": "B", "capacity": 1}])
    run()
    assert read_table(spark, str(tmp_path), STATION_DIMENSION).first().station_name == "B"
    assert {w.run for w in writes(spark, str(tmp_path), STATION_DIMENSION)} == {1, 2}
