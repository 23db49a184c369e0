"""The speed layer: six streaming queries over the three topics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from dockmetrics.model import (
    BIKE_SITUATION,
    BIKE_STATUS,
    FREE_BIKE_STATUS,
    MOST_CHARGED_BIKES,
    RECORD_SCHEMAS,
    RESULT_TABLES,
    STATION_DIMENSION,
    STATION_INFORMATION,
    STATION_STATUS,
    STATION_STATUS_WINDOWED,
    TableSpec,
)
from dockmetrics.operators.bikes import abandoned_count, bike_situation, top_range
from dockmetrics.operators.stations import network_status, network_totals, station_dimension
from dockmetrics.sources.feeds import (
    SourceConf,
    decode,
    ensure_topic,
    explode_feed,
    publish,
    read_landed,
    read_topic,
)
from dockmetrics.sources.files import make_folder, remove_tree
from dockmetrics.sources.tables import ensure_tables, read_table
from dockmetrics.streaming.fanout import adding, fan_out_sink, replacing
from dockmetrics.streaming.live import enrich_sink, read_enriched
from dockmetrics.streaming.progress import counted
from dockmetrics.streaming.sinks import history_sink, replace_sink, upsert_sink


@dataclass(frozen=True)
class StreamConf:
    """Settings of the speed layer; defaults follow the feeds' one-minute polls.

    ``available_now`` processes what the topics hold and stops. ``live_dimension`` lets the
    status rollup follow the stations batch by batch, in two queries, and keeps late reports
    (``streaming.live``). ``fan_out`` feeds the three bike tables from one query that reads
    their topic once; its abandoned counts take late reports in.
    """

    source: SourceConf
    root: str
    history_path: str
    checkpoints: str
    trigger: str = "60 seconds"
    history_trigger: str = "60 minutes"
    watermark: str = "10 minutes"
    window: str | None = None
    top: int = 3
    latest_per_bike: bool = True
    rebalance_history: bool = False
    live_dimension: bool = False
    fan_out: bool = False
    available_now: bool = False


def _records(spark: SparkSession, source: SourceConf, topic: str) -> DataFrame:
    # The two counts differ by the records that were no usable JSON.
    messages = counted(read_topic(spark, source, topic), f"{topic} messages")
    return counted(decode(messages, RECORD_SCHEMAS[topic]), f"{topic} records")


def _dimension_writer(spark: SparkSession, conf: StreamConf) -> DataStreamWriter:
    # From the beginning, whatever the other topics do: a station is announced
    # by the records already there. Later starts go on from the checkpoint.
    source = replace(conf.source, starting_offsets="earliest")
    information = _records(spark, source, STATION_INFORMATION)
    return upsert_sink(
        station_dimension(information),
        conf.root,
        STATION_DIMENSION,
        f"{conf.checkpoints}/station_information",
        output_mode="append",
        compact_every=10,  # every poll writes all stations again
    )


def _stations(spark: SparkSession, conf: StreamConf) -> DataFrame:
    return read_table(spark, conf.root, STATION_DIMENSION)


def _frozen_dimension(spark: SparkSession, conf: StreamConf) -> DataFrame:
    """A copy of the dimension for the stateful rollup.

    Its join is part of the streaming plan, which keeps the file list it started
    with; the table's own files may be folded away while the query runs. Copies
    of earlier starts are no longer read by then.
    """
    copies = f"{conf.checkpoints}/dimension_copies"
    remove_tree(spark, copies)
    path = f"{copies}/{uuid4().hex}"
    _stations(spark, conf).write.parquet(path)
    return spark.read.schema(STATION_DIMENSION.schema).parquet(path)


def _start(conf: StreamConf, writer: DataStreamWriter, every: str) -> StreamingQuery:
    if conf.available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def _start_status_rollup(spark: SparkSession, conf: StreamConf) -> StreamingQuery:
    totals = network_status(
        _records(spark, conf.source, STATION_STATUS),
        _frozen_dimension(spark, conf),
        window=conf.window,
        watermark=conf.watermark,
    )
    checkpoint = f"{conf.checkpoints}/station_status"
    writer = upsert_sink(totals, conf.root, STATION_STATUS_WINDOWED, checkpoint, unique=True)
    return _start(conf, writer, conf.trigger)


def live_folder(conf: StreamConf) -> str:
    """Where a live status rollup passes its reports on and keeps the late ones."""
    return f"{conf.root.rstrip('/')}/live_status"


def _start_enriched(spark: SparkSession, conf: StreamConf) -> StreamingQuery:
    make_folder(spark, f"{live_folder(conf)}/enriched")
    writer = enrich_sink(
        _records(spark, conf.source, STATION_STATUS),
        lambda session: _stations(session, conf),
        live_folder(conf),
        f"{conf.checkpoints}/station_status_enriched",
        watermark=conf.watermark,
    )
    query = _start(conf, writer, conf.trigger)
    if conf.available_now:  # the rollup then reads all that this one passed on
        query.awaitTermination()
    return query


def _start_live_rollup(spark: SparkSession, conf: StreamConf) -> StreamingQuery:
    enriched = read_enriched(spark, live_folder(conf), clean=True)
    totals = network_totals(enriched, window=conf.window, watermark=conf.watermark)
    checkpoint = f"{conf.checkpoints}/station_status_live"
    writer = upsert_sink(totals, conf.root, STATION_STATUS_WINDOWED, checkpoint, unique=True)
    return _start(conf, writer, conf.trigger)


def run_stream_job(spark: SparkSession, conf: StreamConf) -> dict[str, StreamingQuery]:
    """Start the queries and return them by name.

    The station dimension is first brought up to date, then read: once for the
    status rollup, whose stations are those known when it (re)starts, and afresh
    in every micro-batch of the two bike snapshots. ``keep_running`` restarts
    the rollup when the stations change.
    """
    for topic in RECORD_SCHEMAS:
        ensure_topic(spark, conf.source, topic)
    ensure_tables(spark, conf.root, RESULT_TABLES.values())
    drained = _dimension_writer(spark, conf).trigger(availableNow=True).start()
    drained.awaitTermination()

    bikes = _records(spark, conf.source, FREE_BIKE_STATUS)

    def situations(batch: DataFrame) -> DataFrame:
        return bike_situation(batch, _stations(batch.sparkSession, conf))

    def most_charged(batch: DataFrame) -> DataFrame:
        stations = _stations(batch.sparkSession, conf)
        return top_range(batch, stations, conf.top, latest_per_bike=conf.latest_per_bike)

    def snapshot_of_bikes(spec: TableSpec, prepare) -> DataStreamWriter:
        checkpoint = f"{conf.checkpoints}/{spec.name}"
        return replace_sink(bikes, conf.root, spec, checkpoint, prepare=prepare)

    abandoned = upsert_sink(
        abandoned_count(bikes, window=conf.window, watermark=conf.watermark),
        conf.root,
        BIKE_STATUS,
        f"{conf.checkpoints}/abandoned_bikes",
        unique=True,
    )
    history = history_sink(
        _records(spark, conf.source, STATION_STATUS),
        conf.history_path,
        f"{conf.checkpoints}/history",
        rebalance=conf.rebalance_history,
    )
    rollup = {"station_status": lambda: _start_status_rollup(spark, conf)}
    if conf.live_dimension:
        rollup = {
            "station_status_enriched": lambda: _start_enriched(spark, conf),
            "station_status": lambda: _start_live_rollup(spark, conf),
        }
    of_bikes = {
        "abandoned_bikes": lambda: _start(conf, abandoned, conf.trigger),
        "bike_situation": lambda: _start(
            conf, snapshot_of_bikes(BIKE_SITUATION, situations), conf.trigger
        ),
        "most_charged_bikes": lambda: _start(
            conf, snapshot_of_bikes(MOST_CHARGED_BIKES, most_charged), conf.trigger
        ),
    }
    if conf.fan_out:
        tables = {
            BIKE_STATUS: adding(
                conf.root,
                BIKE_STATUS,
                lambda batch: abandoned_count(batch, window=conf.window),
                ["abandoned_bikes_count"],
            ),
            BIKE_SITUATION: replacing(conf.root, BIKE_SITUATION, situations),
            MOST_CHARGED_BIKES: replacing(conf.root, MOST_CHARGED_BIKES, most_charged),
        }
        writer = fan_out_sink(bikes, conf.root, f"{conf.checkpoints}/free_bike_status", tables)
        of_bikes = {"free_bike_status": lambda: _start(conf, writer, conf.trigger)}
    starts = {
        "station_information": lambda: (
            drained
            if conf.available_now
            else _start(conf, _dimension_writer(spark, conf), conf.trigger)
        ),
        **rollup,
        **of_bikes,
        "history": lambda: _start(conf, history, conf.history_trigger),
    }
    return _start_all(starts)


def _start_all(starts: dict[str, Callable[[], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """All queries, or none: if one cannot start, the others are stopped."""
    queries: dict[str, StreamingQuery] = {}
    try:
        for name, start in starts.items():
            queries[name] = start()
    except BaseException:
        for query in queries.values():
            query.stop()
        raise
    return queries


def stations_digest(spark: SparkSession, conf: StreamConf) -> tuple:
    """Number of stations and a hash of what the rollup takes from them."""
    stations = _stations(spark, conf).select("station_id", "capacity")
    digest = stations.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*stations.columns)))
    return tuple(digest.first())


def keep_running(
    spark: SparkSession,
    conf: StreamConf,
    queries: dict[str, StreamingQuery],
    check_seconds: float = 60,
) -> None:
    """Until any query ends; then stop the others and raise that query's error.

    Looks at the stations now and then. If they changed, the status rollup is
    restarted on its checkpoint: it goes on with its state and offsets, and
    counts the stations known by now. A live rollup follows them without.
    """
    known = stations_digest(spark, conf)
    try:
        while all(query.isActive for query in queries.values()):
            ended = queries["station_status"].awaitTermination(check_seconds)
            current = stations_digest(spark, conf)
            if not ended and current != known and not conf.live_dimension:
                queries["station_status"].stop()
                queries["station_status"] = _start_status_rollup(spark, conf)
                known = current
    finally:
        for query in queries.values():
            query.stop()
    for query in queries.values():
        if query.exception():
            raise query.exception()


def wait(
    queries: dict[str, StreamingQuery], *, bounded: bool = True, check_seconds: float = 5
) -> None:
    """Until all queries of a bounded run are done, or, of an unbounded one, until any
    ends. An error of any query stops the others and is raised."""
    try:
        while active := [query for query in queries.values() if query.isActive]:
            ended = [query for query in queries.values() if not query.isActive]
            if any(query.exception() for query in ended) or (ended and not bounded):
                break
            active[0].awaitTermination(check_seconds)
    finally:
        for query in queries.values():
            query.stop()
    for query in queries.values():
        if query.exception():
            raise query.exception()


def run_ingest_job(
    spark: SparkSession,
    documents: SourceConf,
    topics: SourceConf,
    checkpoints: str,
    available_now: bool = False,
) -> dict[str, StreamingQuery]:
    """Turn landed feed documents into topic records, one query per feed."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "60 seconds"}

    def start(topic: str) -> StreamingQuery:
        ensure_topic(spark, documents, topic)
        landed = read_landed(spark, documents, topic)
        writer = publish(explode_feed(landed, topic), topics, topic, f"{checkpoints}/{topic}")
        return writer.trigger(**trigger).start()

    return _start_all({topic: partial(start, topic) for topic in RECORD_SCHEMAS})
