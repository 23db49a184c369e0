"""Live dimension, late reports, quarantine and fan-out: restarts, replays and failures."""

import json
from collections import Counter
from datetime import UTC
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
    STATION_STATUS,
    STATION_STATUS_SCHEMA,
    STATION_STATUS_WINDOWED,
)
from dockmetrics.operators import (
    abandoned_count,
    bike_situation,
    network_status,
    network_totals,
    top_range,
)
from dockmetrics.plans import StreamConf, run_stream_job, wait
from dockmetrics.sources import SourceConf, decode, read_table, read_topic, upsert
from dockmetrics.sources.feeds import parsed_messages
from dockmetrics.sources.logs import read_log
from dockmetrics.streaming import (
    adding,
    enrich_sink,
    fan_out_sink,
    fanout,
    quarantine_sink,
    read_enriched,
    read_late_reports,
    replacing,
    upsert_sink,
)
from dockmetrics.streaming import live as live_module
from dockmetrics.streaming.live import delay_seconds
from dockmetrics.streaming.quarantine import RECORDS, REJECTED, REJECTED_SCHEMA
from test_streaming import T0, bike, drain, report


@pytest.fixture
def topic(spark, tmp_path):
    def open_topic(name, per_trigger=1):
        return read_topic(spark, SourceConf("files", f"{tmp_path}/landing", per_trigger=per_trigger), name)

    return open_topic


@pytest.fixture
def dimension(spark, tmp_path):
    rows = [("a", "Alpha", 10), ("b", "Beta", 10)]
    spark.createDataFrame(rows, "station_id string, station_name string, capacity int").write.parquet(f"{tmp_path}/dim")
    return spark.read.parquet(f"{tmp_path}/dim")


def forget_last_batch(checkpoint):
    """As after a crash between the sink's work and the stream's own commit."""
    done = max((p for p in Path(f"{checkpoint}/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    done.unlink()
    done.with_name(f".{done.name}.crc").unlink(missing_ok=True)


LATE_FILES = [
    [report("a", 1, T0)],
    [report("a", 2, T0 + 3600), report("b", 9, T0 + 1)],
    [report("b", 3, T0 + 1), report("a", 4, T0 + 3601), report("unknown", 5, T0 + 2)],
    [report("b", 4, T0 + 3000), report("a", 4, T0 + 3001), report("a", 6, T0 + 3602)],
]


def test_late_reports_and_totals_add_up_to_the_input(spark, tmp_path, land, topic, dimension, rows_of):
    for records in LATE_FILES:
        land(STATION_STATUS, records)
    status = decode(topic(STATION_STATUS), STATION_STATUS_SCHEMA)
    folder = f"{tmp_path}/live"
    drain(enrich_sink(status, lambda _: dimension, folder, f"{tmp_path}/ck1"))
    late = read_late_reports(spark, folder)
    shown = late.select("station_id", "last_reported", F.unix_seconds("watermark"), "batch_id")
    assert rows_of(shown) == [
        ("a", T0 + 3001, T0 + 3001, 3),
        ("b", T0 + 1, T0 + 3000, 2),
        ("b", T0 + 3000, T0 + 3001, 3),
        ("unknown", T0 + 2, T0 + 3000, 2),
    ]
    totals = network_totals(read_enriched(spark, folder), watermark="10 minutes")
    drain(upsert_sink(totals, f"{tmp_path}/live_tables", STATION_STATUS_WINDOWED, f"{tmp_path}/ck3"))
    left = [r for file in LATE_FILES for r in file]
    for r in late.collect():
        left.remove(report(r.station_id, r.num_bikes_available, r.last_reported))
    expected = network_status(spark.createDataFrame(left, STATION_STATUS_SCHEMA), dimension)
    assert rows_of(read_table(spark, f"{tmp_path}/live_tables", STATION_STATUS_WINDOWED)) == rows_of(expected)
    kept = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/enriched").count()
    assert kept + late.count() == sum(map(len, LATE_FILES))
    # Spark's own operator drops only some of these: it lags by a batch
    plain = network_status(status, dimension, watermark="10 minutes")
    query = drain(upsert_sink(plain, f"{tmp_path}/plain", STATION_STATUS_WINDOWED, f"{tmp_path}/ck2"))
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert 0 < dropped <= late.count()


def test_a_repeated_batch_is_passed_on_once_and_cut_alike(spark, tmp_path, land, topic, dimension):
    folder = f"{tmp_path}/live"

    def run():
        status = decode(topic(STATION_STATUS), STATION_STATUS_SCHEMA)
        drain(enrich_sink(status, lambda _: dimension, folder, f"{tmp_path}/ck"))
        passed = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/enriched").count()
        return passed, read_late_reports(spark, folder).count()

    for records in LATE_FILES[:3]:
        land(STATION_STATUS, records)
    assert run() == (4, 2)
    forget_last_batch(f"{tmp_path}/ck")
    assert run() == (4, 2)
    land(STATION_STATUS, LATE_FILES[3])
    assert run() == (5, 4)


def test_a_stop_before_the_batch_is_passed_on(spark, tmp_path, land, topic, dimension, monkeypatch):
    folder = f"{tmp_path}/live"
    for records in LATE_FILES[:2]:
        land(STATION_STATUS, records)

    def run():
        status = decode(topic(STATION_STATUS, per_trigger=None), STATION_STATUS_SCHEMA)
        drain(enrich_sink(status, lambda _: dimension, folder, f"{tmp_path}/ck"))

    def breaks(*_):
        raise OSError("no rename")

    monkeypatch.setattr(live_module, "move", breaks)
    with pytest.raises(Exception, match="no rename"):
        run()
    monkeypatch.undo()
    run()
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/enriched").count() == 3


def test_delays():
    assert [delay_seconds(t) for t in ("10 minutes", "1 hour", " 90 seconds ", "2 days")] == [600, 3600, 90, 172800]
    for wrong in ("", "ten minutes", "10", "10 years"):
        with pytest.raises(ValueError, match="no delay"):
            delay_seconds(wrong)


def test_live_and_fanned_out_job_equals_the_plain_one(spark, tmp_path, land, rows_of):
    land(STATION_INFORMATION, [{"station_id": s, "name": s.upper(), "capacity": 10} for s in "ab"])
    for records in ([report("a", 3, T0), report("b", 10, T0)], [report("a", 0, T0 + 60), "junk"]):
        land(STATION_STATUS, records)
    land(FREE_BIKE_STATUS, [bike("1", "a", T0, 500, reserved=True), bike("2", "", T0), bike("3", "b", T0, 900)])

    def run(name, **options):
        conf = StreamConf(
            source=SourceConf("files", f"{tmp_path}/landing"),
            root=f"{tmp_path}/{name}/tables",
            history_path=f"{tmp_path}/{name}/history",
            checkpoints=f"{tmp_path}/{name}/ck",
            available_now=True,
            **options,
        )
        queries = run_stream_job(spark, conf)
        wait(queries)
        specs = STATION_STATUS_WINDOWED, BIKE_STATUS, BIKE_SITUATION, MOST_CHARGED_BIKES
        return set(queries), [rows_of(read_table(spark, conf.root, spec)) for spec in specs]

    plain, expected = run("plain")
    other, found = run("other", live_dimension=True, fan_out=True)
    assert found == expected and all(expected)
    assert "free_bike_status" in other and "station_status_enriched" in other
    assert len(plain) == 6 and len(other) == 5


def test_a_station_added_in_mid_stream_counts_without_a_restart(spark, tmp_path, land, topic):
    root = str(tmp_path)
    row = "station_id string, station_name string, capacity int"
    upsert(spark.createDataFrame([("a", "A", 10)], row), root, STATION_DIMENSION)
    land(STATION_STATUS, [report("a", 1, T0), report("b", 2, T0)])
    status = decode(topic(STATION_STATUS), STATION_STATUS_SCHEMA)
    known = lambda session: read_table(session, root, STATION_DIMENSION)
    query = enrich_sink(status, known, f"{root}/live", f"{root}/ck").start()
    try:
        query.processAllAvailable()
        upsert(spark.createDataFrame([("b", "B", 10)], row), root, STATION_DIMENSION)
        land(STATION_STATUS, [report("a", 3, T0 + 60), report("b", 4, T0 + 60)])
        query.processAllAvailable()
    finally:
        query.stop()
    passed = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/live/enriched")
    assert sorted((r.station_id, r.num_bikes_available) for r in passed.collect()) == [("a", 1), ("a", 3), ("b", 4)]


# --- quarantine -------------------------------------------------------------------

MESSAGES = [
    json.dumps(report("a", 1, T0)),
    '{"station_id":"b","num_bikes_available":"many"}',
    '{"other":1}',
    "{}",
    "[1, 2]",
    "junk",
    '{"station_id":',
    "",
]


def test_each_message_is_usable_or_has_a_reason(spark):
    messages = spark.createDataFrame([(m,) for m in [*MESSAGES, None]], "value string")
    parsed = parsed_messages(messages, STATION_STATUS_SCHEMA)
    reasons = {r.text: r.reason for r in parsed.collect()}
    assert reasons[MESSAGES[0]] is None and reasons[MESSAGES[1]] is None
    assert reasons[None] == "no text"
    assert reasons['{"other":1}'] == reasons["{}"] == "no usable field"
    assert reasons["junk"] == reasons['{"station_id":'] == "not JSON"
    usable = parsed.filter("reason is null").select("record.*")
    assert sorted(map(str, usable.collect())) == sorted(map(str, decode(messages, STATION_STATUS_SCHEMA).collect()))


def quarantined(spark, root):
    records = read_log(spark, root, RECORDS, STATION_STATUS_SCHEMA)
    rejected = read_log(spark, root, REJECTED, REJECTED_SCHEMA)
    return records.count(), Counter(r.text for r in rejected.collect())


def test_quarantine_keeps_both_tables_in_step(spark, tmp_path, land, topic, monkeypatch):
    root = f"{tmp_path}/tables"

    def run():
        drain(quarantine_sink(topic(STATION_STATUS), STATION_STATUS_SCHEMA, root, f"{tmp_path}/ck"))

    assert quarantined(spark, root) == (0, {})
    land(STATION_STATUS, MESSAGES[:4])
    run()
    first = quarantined(spark, root)
    assert first == (2, {'{"other":1}': 1, "{}": 1})
    forget_last_batch(f"{tmp_path}/ck")
    run()
    assert quarantined(spark, root) == first
    # a failure between the two tables shows neither
    land(STATION_STATUS, MESSAGES[4:7])
    writer = type(spark.range(1).write)
    save, count = writer.parquet, iter(range(100))

    def second_write_fails(self, *args, **options):
        if next(count) == 1:
            raise OSError("disk full")
        save(self, *args, **options)

    monkeypatch.setattr(writer, "parquet", second_write_fails)
    with pytest.raises(Exception, match="disk full"):
        run()
    monkeypatch.undo()
    assert quarantined(spark, root) == first
    run()
    assert quarantined(spark, root) == (2, {**first[1], "junk": 1, "[1, 2]": 1, '{"station_id":': 1})


# --- fan-out ----------------------------------------------------------------------


def bike_tables(root, dimension):
    return {
        BIKE_STATUS: adding(root, BIKE_STATUS, abandoned_count, ["abandoned_bikes_count"]),
        BIKE_SITUATION: replacing(root, BIKE_SITUATION, lambda b: bike_situation(b, dimension)),
        MOST_CHARGED_BIKES: replacing(root, MOST_CHARGED_BIKES, lambda b: top_range(b, dimension)),
    }


def counts(spark, root):
    return sorted((r.timestamp.replace(tzinfo=UTC).timestamp() - T0, r.abandoned_bikes_count) for r in read_table(spark, root, BIKE_STATUS).collect())


def test_fan_out_reads_each_batch_once(spark, tmp_path, land, topic, dimension):
    root = f"{tmp_path}/tables"
    land(FREE_BIKE_STATUS, [bike(str(i), "", T0) for i in range(5)] + [bike("9", "a", T0, reserved=True)])
    land(FREE_BIKE_STATUS, [bike("1", "", T0 + 60), bike("2", "", T0), bike("3", "b", T0, 700)])
    records = decode(topic(FREE_BIKE_STATUS), FREE_BIKE_STATUS_SCHEMA)
    query = drain(fan_out_sink(records, root, f"{tmp_path}/ck", bike_tables(root, dimension)))
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [6, 3]
    assert counts(spark, root) == [(0, 6), (60, 1)]
    assert read_table(spark, root, BIKE_SITUATION).count() == 0
    assert [r.bike_id for r in read_table(spark, root, MOST_CHARGED_BIKES).collect()] == ["3"]


def test_a_stop_between_two_tables_repeats_and_loses_nothing(spark, tmp_path, land, topic, dimension, monkeypatch):
    root = f"{tmp_path}/tables"
    stored = Counter()

    def run():
        tables = bike_tables(root, dimension)
        for spec, save in tables.items():
            def counted(batch, run, batch_id, spec=spec, save=save):
                save(batch, run, batch_id)
                stored[spec.name, batch_id] += 1
            tables[spec] = counted
        records = decode(topic(FREE_BIKE_STATUS), FREE_BIKE_STATUS_SCHEMA)
        drain(fan_out_sink(records, root, f"{tmp_path}/ck", tables, compact_every=1))

    land(FREE_BIKE_STATUS, [bike("1", "", T0), bike("2", "a", T0, reserved=True)])
    run()
    land(FREE_BIKE_STATUS, [bike("3", "", T0), bike("4", "b", T0, disabled=True)])
    marked = fanout.write_bytes

    def stops(session, path, content):
        if path.endswith(f"tables/{BIKE_SITUATION.name}") and content == b"1":
            raise OSError("stopped")
        marked(session, path, content)

    monkeypatch.setattr(fanout, "write_bytes", stops)
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.undo()
    run()
    assert counts(spark, root) == [(0, 2)]
    assert [r.bike_id for r in read_table(spark, root, BIKE_SITUATION).collect()] == ["4"]
    assert stored[BIKE_STATUS.name, 1] == 1  # it had its marker
    assert stored[BIKE_SITUATION.name, 1] == 2
    forget_last_batch(f"{tmp_path}/ck")
    run()
    assert counts(spark, root) == [(0, 2)]


def test_a_batch_whose_counts_were_written_but_not_marked_is_added_once(spark, tmp_path, land, topic, dimension, monkeypatch):
    root = f"{tmp_path}/tables"

    def run():
        records = decode(topic(FREE_BIKE_STATUS), FREE_BIKE_STATUS_SCHEMA)
        drain(fan_out_sink(records, root, f"{tmp_path}/ck", bike_tables(root, dimension)))

    land(FREE_BIKE_STATUS, [bike("1", "", T0)])
    run()
    land(FREE_BIKE_STATUS, [bike("2", "", T0)])

    def stops(*_):
        raise OSError("stopped")

    monkeypatch.setattr(fanout, "write_bytes", stops)
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.undo()
    run()
    assert counts(spark, root) == [(0, 2)]
