"""

Queries return integers, strings, dates and zone-less timestamps, so values do
not depend on the session time zone. Those that need files of their own (stream
inputs, tables, history) put them below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics import fixtures
from dockmetrics.fixtures import zoneless
from dockmetrics.model import (
    BATCH_STATION_STATUS,
    BIKE_SITUATION,
    BIKE_STATUS,
    FREE_BIKE_STATUS,
    FREE_BIKE_STATUS_SCHEMA,
    HISTORY_SCHEMA,
    MOST_CHARGED_BIKES,
    STATION_DIMENSION,
    STATION_INFORMATION,
    STATION_INFORMATION_SCHEMA,
    STATION_STATUS,
    STATION_STATUS_SCHEMA,
    STATION_STATUS_WINDOWED,
    TableSpec,
)
from dockmetrics.operators import bikes, daily, keyed, stations
from dockmetrics.plans import (
    StreamConf,
    partials,
    run_daily_job,
    run_stream_job,
    snapshot,
    wait,
)
from dockmetrics.plans.daily import preview
from dockmetrics.session import shared_folder
from dockmetrics.sources import (
    SourceConf,
    bad_record_counts,
    compact,
    decode,
    ensure_tables,
    ensure_topic,
    explode_feed,
    publish,
    read_history,
    read_table,
    read_topic,
    union_history,
    upsert,
    write_history,
)
from dockmetrics.sources.files import (
    exists,
    make_folder,
    matching,
    read_bytes,
    set_modified,
    write_bytes,
)
from dockmetrics.sources.logs import read_log
from dockmetrics.sources.versions import merge, read_version
from dockmetrics.streaming import (
    adding,
    enrich_sink,
    fan_out_sink,
    history_sink,
    quarantine_sink,
    read_enriched,
    read_late_reports,
    replace_sink,
    replacing,
    upsert_sink,
)
from dockmetrics.streaming.quarantine import REJECTED_SCHEMA

# The operators of dockmetrics.llm and their pipeline are optional, and so is what they import.
try:
    from dockmetrics.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
COMPUTED_AT = datetime(2024, 2, 1, tzinfo=UTC)
HISTORY_DAY = "2024-01-15"

LATEST_STATUS = TableSpec(
    name="latest_status",
    schema=STATION_STATUS_SCHEMA,
    keys=("station_id",),
    order=(("station_id", False),),
    version=("last_reported",),
)


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.station_dimension(fixtures.station_information(spark, sf_dir))


def _as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _time_slices(records: DataFrame, slices: int = 3) -> list[DataFrame]:
    """The records cut into consecutive spans of event time."""
    shares = [i / slices for i in range(1, slices)]
    cuts = records.agg(F.percentile_approx("last_reported", shares, 100)).first()[0] or []
    second = F.coalesce("last_reported", F.lit(0)).cast("long")
    edges = [-(2**31), *sorted(set(cuts)), 2**31]
    return [
        records.filter((second >= low) & (second < high)) for low, high in zip(edges, edges[1:])
    ]


def _replay(
    parts: list[DataFrame],
    schema: T.StructType,
    folder: str,
    sink: Callable[[DataFrame], object],
) -> None:
    """Land each part as JSON lines and run the stream up to it, restarting from
    the checkpoint every time."""
    for part in parts:
        _as_messages(part).write.mode("append").text(f"{folder}/landing")
        stream = part.sparkSession.readStream.text(f"{folder}/landing")
        sink(decode(stream, schema)).trigger(availableNow=True).start().awaitTermination()


# --- rollups, flags, dimension ------------------------------------------------


def network_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir)
    return zoneless(stations.network_status(status, _stations(spark, sf_dir)))


def network_status_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir, tick=1)
    rollup = stations.network_status(status, _stations(spark, sf_dir), window="1 minute")
    return zoneless(rollup)


def station_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = fixtures.station_status(spark, sf_dir).join(
        _stations(spark, sf_dir).select("station_id", "capacity"), "station_id"
    )
    return stations.with_station_flags(joined)


def station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stations(spark, sf_dir)


# --- bikes --------------------------------------------------------------------


def abandoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bikes.abandoned(fixtures.free_bike_status(spark, sf_dir))


def abandoned_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(bikes.abandoned_count(fixtures.free_bike_status(spark, sf_dir)))


def bike_situation(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = fixtures.free_bike_status(spark, sf_dir)
    return zoneless(bikes.bike_situation(reports, _stations(spark, sf_dir)))


def top_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = fixtures.free_bike_status(spark, sf_dir)
    return zoneless(bikes.top_range(reports, _stations(spark, sf_dir), latest_per_bike=False))


def top_range_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = fixtures.free_bike_status(spark, sf_dir)
    return zoneless(bikes.top_range(reports, _stations(spark, sf_dir)))


# --- daily figures and history ------------------------------------------------


def daily_station_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir)
    figures = daily.daily_station_stats(status, _stations(spark, sf_dir), COMPUTED_AT)
    return zoneless(figures)


def daily_station_stats_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir)
    figures = daily.daily_station_stats(
        status, _stations(spark, sf_dir), COMPUTED_AT, by_hour=True
    )
    return zoneless(figures)


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a history that a stream wrote."""
    folder = shared_folder(spark, "daily-job")
    _replay(
        _time_slices(fixtures.station_status(spark, sf_dir), 2),
        STATION_STATUS_SCHEMA,
        folder,
        lambda status: history_sink(
            status, f"{folder}/history", f"{folder}/checkpoint", rebalance=True
        ),
    )
    upsert(_stations(spark, sf_dir), folder, STATION_DIMENSION)
    run_daily_job(
        spark,
        HISTORY_DAY,
        root=folder,
        history_path=f"{folder}/history",
        computed_at=COMPUTED_AT,
    )
    return zoneless(read_table(spark, folder, BATCH_STATION_STATUS))


def daily_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of all days, from partials that two updates took in."""
    folder = shared_folder(spark, "partials")
    for part in _time_slices(fixtures.station_status(spark, sf_dir), 2):
        write_history(part, f"{folder}/history")
        partials.update_partials(spark, f"{folder}/partials", f"{folder}/history")
    return zoneless(
        partials.daily_from_partials(spark, f"{folder}/partials", _stations(spark, sf_dir), COMPUTED_AT)
    )


def profile_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from stored sketches; whether its estimates are within their stated error
    (three deviations) of the exact figures."""
    folder = shared_folder(spark, "sketches")
    status = fixtures.station_status(spark, sf_dir)
    for part in _time_slices(status, 2):
        write_history(part, f"{folder}/history")
        partials.update_partials(spark, f"{folder}/partials", f"{folder}/history")
    found = partials.profile_from_sketches(spark, f"{folder}/partials", ranks=[0.5])
    exact, middle = daily.profile(status).first().station_count, found.first().seconds[0]
    below = F.avg((F.col("last_reported") <= middle).cast("int")).alias("rank")
    rank = status.agg(below).first().rank
    return found.select(
        "row_count",
        "first_reported",
        "last_reported",
        (F.abs(F.col("station_count") - exact) <= 0.05 * exact).alias("count_is_close"),
        F.lit(abs(rank - 0.5) <= 0.05).alias("median_is_close"),
    )


def history_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "history-day")
    write_history(fixtures.station_status(spark, sf_dir), folder)
    return zoneless(read_history(spark, folder, HISTORY_DAY))


def history_day_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "history-month")
    write_history(fixtures.station_status(spark, sf_dir), folder)
    return zoneless(read_history(spark, folder, day_of_month=5))


def history_with_damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one day, the files of hour 3 lose their ends and those of hour 4 break in the middle."""
    folder = shared_folder(spark, "history-damaged")
    write_history(fixtures.station_status(spark, sf_dir), folder)
    for hour in (3, 4):
        for file in matching(spark, f"{folder}/day={HISTORY_DAY}/hour={hour}/*.parquet"):
            content = bytearray(read_bytes(spark, file))
            if hour == 3:
                del content[-8:]
            else:
                content[4:40] = bytes(36)
            write_bytes(spark, file, bytes(content))
    return zoneless(read_history(spark, folder, skip_unreadable=True))


def preview_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a day in order of time: what the daily job logs, made definite."""
    folder = shared_folder(spark, "preview")
    write_history(fixtures.station_status(spark, sf_dir), folder)
    history = read_history(spark, folder, HISTORY_DAY).orderBy(*HISTORY_SCHEMA.fieldNames()[:4][::-1])
    return zoneless(spark.createDataFrame(preview(history), HISTORY_SCHEMA))


def union_of_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir)
    with_bikes = status.filter("num_bikes_available > 0")
    without_bikes = status.filter("num_bikes_available = 0").drop("num_bikes_available")
    return union_history([with_bikes, without_bikes])


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.profile(fixtures.station_status(spark, sf_dir))


# --- feeds --------------------------------------------------------------------


def decode_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _as_messages(fixtures.station_status(spark, sf_dir))
    return decode(messages, STATION_STATUS_SCHEMA)


def decode_with_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record cut short where its station has no bikes: no longer JSON."""
    status = fixtures.station_status(spark, sf_dir)
    whole = F.to_json(F.struct(*status.columns))
    cut = F.when(F.col("num_bikes_available") == 0, F.substring(whole, 1, 9)).otherwise(whole)
    return bad_record_counts(status.select(cut.alias("value")), STATION_STATUS_SCHEMA)


def explode_status_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = explode_feed(fixtures.status_documents(spark, sf_dir), STATION_STATUS)
    return decode(records, STATION_STATUS_SCHEMA)


# --- keyed tables and serving -------------------------------------------------


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = fixtures.station_status(spark, sf_dir)
    return keyed.latest_by_key(status, ["station_id"], ["last_reported"])


def upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "upsert")
    for part in _time_slices(fixtures.station_status(spark, sf_dir), 2):
        upsert(part, folder, LATEST_STATUS)
    return read_table(spark, folder, LATEST_STATUS)


def upsert_and_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "compact")
    for part in _time_slices(fixtures.station_status(spark, sf_dir)):
        upsert(part, folder, LATEST_STATUS)
        compact(spark, folder, LATEST_STATUS)
    return read_table(spark, folder, LATEST_STATUS)


def merged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three merges into a table of numbered snapshots, read at its newest version."""
    folder = shared_folder(spark, "versions")
    for part in _time_slices(fixtures.station_status(spark, sf_dir)):
        merge(part, folder, LATEST_STATUS, rows_per_file=50)
    return read_version(spark, folder, LATEST_STATUS)


def snapshot_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    upsert(_stations(spark, sf_dir), folder, STATION_DIMENSION)
    shown = snapshot(spark, folder, [STATION_DIMENSION.name], labels=True)
    return shown["Station Information"]


def snapshot_network_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    rollup = stations.network_status(
        fixtures.station_status(spark, sf_dir), _stations(spark, sf_dir)
    )
    upsert(rollup, folder, STATION_STATUS_WINDOWED)
    name = STATION_STATUS_WINDOWED.name
    return zoneless(snapshot(spark, folder, [name])[name])


def snapshot_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    figures = daily.daily_station_stats(
        fixtures.station_status(spark, sf_dir), _stations(spark, sf_dir), COMPUTED_AT
    )
    upsert(figures, folder, BATCH_STATION_STATUS)
    name = BATCH_STATION_STATUS.name
    return zoneless(snapshot(spark, folder, [name])[name])


def snapshot_bike_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    upsert(bikes.abandoned_count(fixtures.free_bike_status(spark, sf_dir)), folder, BIKE_STATUS)
    return zoneless(snapshot(spark, folder, [BIKE_STATUS.name])[BIKE_STATUS.name])


def snapshot_bike_situation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    reports = fixtures.free_bike_status(spark, sf_dir)
    upsert(bikes.bike_situation(reports, _stations(spark, sf_dir)), folder, BIKE_SITUATION)
    return zoneless(snapshot(spark, folder, [BIKE_SITUATION.name])[BIKE_SITUATION.name])


def snapshot_most_charged(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "snapshot")
    reports = fixtures.free_bike_status(spark, sf_dir)
    upsert(bikes.top_range(reports, _stations(spark, sf_dir)), folder, MOST_CHARGED_BIKES)
    return zoneless(snapshot(spark, folder, [MOST_CHARGED_BIKES.name])[MOST_CHARGED_BIKES.name])


# --- streams ------------------------------------------------------------------


def stream_feed_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    fixtures.status_documents(spark, sf_dir).write.text(f"{folder}/documents")
    topics = SourceConf("files", f"{folder}/topics")
    records = explode_feed(spark.readStream.text(f"{folder}/documents"), STATION_STATUS)
    writer = publish(records, topics, STATION_STATUS, f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return decode(spark.read.text(f"{folder}/topics/{STATION_STATUS}"), STATION_STATUS_SCHEMA)


def stream_network_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    known = _stations(spark, sf_dir)
    _replay(
        _time_slices(fixtures.station_status(spark, sf_dir)),
        STATION_STATUS_SCHEMA,
        folder,
        lambda status: upsert_sink(
            stations.network_status(status, known, watermark="10 minutes"),
            folder,
            STATION_STATUS_WINDOWED,
            f"{folder}/checkpoint",
        ),
    )
    return zoneless(read_table(spark, folder, STATION_STATUS_WINDOWED))


def stream_abandoned_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    _replay(
        _time_slices(fixtures.free_bike_status(spark, sf_dir)),
        FREE_BIKE_STATUS_SCHEMA,
        folder,
        lambda reports: upsert_sink(
            bikes.abandoned_count(reports, watermark="10 minutes"),
            folder,
            BIKE_STATUS,
            f"{folder}/checkpoint",
        ),
    )
    return zoneless(read_table(spark, folder, BIKE_STATUS))


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    _replay(
        _time_slices(fixtures.station_status(spark, sf_dir)),
        STATION_STATUS_SCHEMA,
        folder,
        lambda status: history_sink(
            status, f"{folder}/history", f"{folder}/checkpoint", rebalance=True
        ),
    )
    return zoneless(read_history(spark, f"{folder}/history"))


def stream_bike_situation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    known = _stations(spark, sf_dir)
    _replay(
        [fixtures.free_bike_status(spark, sf_dir)],
        FREE_BIKE_STATUS_SCHEMA,
        folder,
        lambda reports: replace_sink(
            reports,
            folder,
            BIKE_SITUATION,
            f"{folder}/checkpoint",
            prepare=lambda batch: bikes.bike_situation(batch, known),
        ),
    )
    return zoneless(read_table(spark, folder, BIKE_SITUATION))


def replace_sink_top_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    known = _stations(spark, sf_dir)
    _replay(
        [fixtures.free_bike_status(spark, sf_dir)],
        FREE_BIKE_STATUS_SCHEMA,
        folder,
        lambda reports: replace_sink(
            reports,
            folder,
            MOST_CHARGED_BIKES,
            f"{folder}/checkpoint",
            prepare=lambda batch: bikes.top_range(batch, known),
        ),
    )
    return zoneless(read_table(spark, folder, MOST_CHARGED_BIKES))


def stream_station_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "stream")
    information = fixtures.station_information(spark, sf_dir)
    _replay(
        [information, information],
        STATION_INFORMATION_SCHEMA,
        folder,
        lambda records: upsert_sink(
            stations.station_dimension(records),
            folder,
            STATION_DIMENSION,
            f"{folder}/checkpoint",
            output_mode="append",
        ),
    )
    return read_table(spark, folder, STATION_DIMENSION)


def stream_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest slice is read first; the files of the others land with times of a year
    before and are read all the same."""
    folder = shared_folder(spark, "stream")
    source = SourceConf("files", f"{folder}/topics")
    ensure_topic(spark, source, STATION_STATUS)
    for age, part in enumerate(reversed(_time_slices(fixtures.station_status(spark, sf_dir)))):
        landing = f"{folder}/topics/{STATION_STATUS}"
        before = set(matching(spark, f"{landing}/part-*"))
        _as_messages(part).write.mode("append").text(landing)
        for file in set(matching(spark, f"{landing}/part-*")) - before:
            set_modified(spark, file, time.time() - age * 365 * 86400)
        records = decode(read_topic(spark, source, STATION_STATUS), STATION_STATUS_SCHEMA)
        sink = history_sink(records, f"{folder}/history", f"{folder}/checkpoint", rebalance=True)
        sink.trigger(availableNow=True).start().awaitTermination()
    return zoneless(read_history(spark, f"{folder}/history"))


#: Early and later reports, for streams whose batches an oracle must know.
STREAM_CUT = int(datetime(2024, 1, 16, tzinfo=UTC).timestamp())


def stream_live_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries that run on while a third of the stations are announced between two slices."""
    folder = shared_folder(spark, "live")
    known, status = _stations(spark, sf_dir), fixtures.station_status(spark, sf_dir)
    announced_late = F.col("station_id").cast("int") % 3 == 0
    upsert(known.filter(~announced_late), folder, STATION_DIMENSION)
    ensure_tables(spark, folder, [STATION_STATUS_WINDOWED])
    source = SourceConf("files", f"{folder}/topics")
    landing = f"{folder}/topics/{STATION_STATUS}"
    _as_messages(status.filter(F.col("last_reported") < STREAM_CUT)).write.text(landing)
    make_folder(spark, f"{folder}/enriched")
    enriched = enrich_sink(
        decode(read_topic(spark, source, STATION_STATUS), STATION_STATUS_SCHEMA),
        lambda session: read_table(session, folder, STATION_DIMENSION),
        folder,
        f"{folder}/checkpoint/enriched",
    ).start()
    totals = stations.network_totals(read_enriched(spark, folder), watermark="10 minutes")
    rollup = upsert_sink(
        totals, folder, STATION_STATUS_WINDOWED, f"{folder}/checkpoint/rollup", unique=True
    ).start()
    try:
        enriched.processAllAvailable()
        upsert(known.filter(announced_late), folder, STATION_DIMENSION)
        _as_messages(status.filter(F.col("last_reported") >= STREAM_CUT)).write.mode("append").text(landing)
        enriched.processAllAvailable()
        rollup.processAllAvailable()
    finally:
        enriched.stop()
        rollup.stop()
    return zoneless(read_table(spark, folder, STATION_STATUS_WINDOWED))


def stream_late_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the reports lands after all others; what is behind the watermark by then."""
    folder = shared_folder(spark, "late")
    status, known = fixtures.station_status(spark, sf_dir), _stations(spark, sf_dir)
    lagging = F.col("num_docks_available") % 7 == 3
    early = F.col("last_reported") < STREAM_CUT
    _replay(
        [status.filter(~lagging & early), status.filter(~lagging & ~early), status.filter(lagging)],
        STATION_STATUS_SCHEMA,
        folder,
        lambda reports: enrich_sink(reports, lambda _: known, folder, f"{folder}/checkpoint"),
    )
    return zoneless(read_late_reports(spark, folder).drop("run"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by what became of them: cut short where a station has no bikes, without a
    known field where it has no docks, else usable. Restarts between slices."""
    folder = shared_folder(spark, "quarantine")
    for part in _time_slices(fixtures.station_status(spark, sf_dir), 2):
        whole = F.to_json(F.struct(*part.columns))
        other = F.to_json(F.struct(F.col("num_bikes_available").alias("other")))
        message = F.when(F.col("num_bikes_available") == 0, F.substring(whole, 1, 20))
        message = message.when(F.col("num_docks_available") == 0, other).otherwise(whole)
        part.select(message.alias("value")).write.mode("append").text(f"{folder}/landing")
        sink = quarantine_sink(
            spark.readStream.text(f"{folder}/landing"), STATION_STATUS_SCHEMA, f"{folder}/tables", f"{folder}/checkpoint"
        )
        sink.trigger(availableNow=True).start().awaitTermination()
    rejected = read_log(spark, f"{folder}/tables", "rejected", REJECTED_SCHEMA)
    usable = read_log(spark, f"{folder}/tables", "records", STATION_STATUS_SCHEMA)
    shown = usable.select(F.to_json(F.struct(*STATION_STATUS_SCHEMA.fieldNames())).alias("text"), F.lit("usable").alias("reason"))
    both = rejected.select("text", "reason").unionByName(shown)
    return both.groupBy("reason", "text").agg(F.count(F.lit(1)).alias("message_count"))


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query feeds three tables from two slices, the second one after a restart."""
    folder = shared_folder(spark, "fan-out")
    known, reports = _stations(spark, sf_dir), fixtures.free_bike_status(spark, sf_dir)
    early = F.col("last_reported") < STREAM_CUT
    tables = {
        BIKE_STATUS: adding(folder, BIKE_STATUS, bikes.abandoned_count, ["abandoned_bikes_count"]),
        BIKE_SITUATION: replacing(folder, BIKE_SITUATION, lambda b: bikes.bike_situation(b, known)),
        MOST_CHARGED_BIKES: replacing(folder, MOST_CHARGED_BIKES, lambda b: bikes.top_range(b, known)),
    }
    _replay(
        # single reports of the early days come again with the second slice, and are added
        [reports.filter(early), reports.filter(~early | (F.col("current_range_meters") % 50 == 0))],
        FREE_BIKE_STATUS_SCHEMA,
        folder,
        lambda records: fan_out_sink(records, folder, f"{folder}/checkpoint", tables),
    )
    kind, count = F.lit(None).cast("string"), F.lit(None).cast("long")
    parts = [
        read_table(spark, folder, BIKE_STATUS).select(
            F.lit("bike_status").alias("table_name"), "timestamp", kind.alias("bike_id"), kind.alias("detail"),
            F.col("abandoned_bikes_count").alias("number"),
        ),
        read_table(spark, folder, BIKE_SITUATION).select(
            F.lit("bike_situation"), "timestamp", "bike_id", F.concat_ws(" at ", "situation", "station_name"), count
        ),
        read_table(spark, folder, MOST_CHARGED_BIKES).select(
            F.lit("most_charged_bikes"), "timestamp", "bike_id", "station_name", count
        ),
    ]
    return zoneless(parts[0].union(parts[1]).union(parts[2]))


_stream_jobs: dict[tuple[str, str], StreamConf] = {}


def _stream_job(spark: SparkSession, sf_dir: str) -> StreamConf:
    """The six queries over landed topics, each until it has read all. One run feeds the
    rows of all its tables."""
    key = spark.sparkContext.applicationId, sf_dir
    done = _stream_jobs.get(key)
    if done is None or not exists(spark, done.root):
        _stream_jobs[key] = _run_stream_job(spark, sf_dir)
    return _stream_jobs[key]


def _run_stream_job(spark: SparkSession, sf_dir: str) -> StreamConf:
    folder = shared_folder(spark, "stream-job")
    feeds = {
        STATION_INFORMATION: fixtures.station_information(spark, sf_dir),
        STATION_STATUS: fixtures.station_status(spark, sf_dir),
        FREE_BIKE_STATUS: fixtures.free_bike_status(spark, sf_dir),
    }
    for topic, records in feeds.items():
        _as_messages(records).write.text(f"{folder}/topics/{topic}")
    conf = StreamConf(
        source=SourceConf("files", f"{folder}/topics"),
        root=f"{folder}/tables",
        history_path=f"{folder}/history",
        checkpoints=f"{folder}/checkpoints",
        rebalance_history=True,
        available_now=True,
    )
    wait(run_stream_job(spark, conf))
    return conf


def stream_job_network_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = _stream_job(spark, sf_dir)
    return zoneless(read_table(spark, conf.root, STATION_STATUS_WINDOWED))


def stream_job_abandoned_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = _stream_job(spark, sf_dir)
    return zoneless(read_table(spark, conf.root, BIKE_STATUS))


def stream_job_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    conf = _stream_job(spark, sf_dir)
    return zoneless(read_history(spark, conf.history_path))


def entry(spark: SparkSession) -> DataFrame:
    return network_status(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per implemented query or operator."""
    return (
        core_queries()
        | (llm.queries() if llm else {})
        | ({"pipeline": corpus_pipeline.run} if corpus_pipeline else {})
    )


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Those that do without the optional parts."""
    return {
        "network_status": network_status,
        "network_status_minute": network_status_minute,
        "station_flags": station_flags,
        "station_dimension": station_dimension,
        "abandoned": abandoned,
        "abandoned_count": abandoned_count,
        "bike_situation": bike_situation,
        "top_range": top_range,
        "top_range_latest": top_range_latest,
        "daily_station_stats": daily_station_stats,
        "daily_station_stats_by_hour": daily_station_stats_by_hour,
        "daily_job": daily_job,
        "daily_from_partials": daily_from_partials,
        "profile_from_sketches": profile_from_sketches,
        "history_day": history_day,
        "history_day_of_month": history_day_of_month,
        "history_with_damaged_files": history_with_damaged_files,
        "preview": preview_of_a_day,
        "union_history": union_of_histories,
        "profile": profile,
        "decode_status": decode_status,
        "decode_with_junk": decode_with_junk,
        "explode_feed": explode_status_feed,
        "latest_by_key": latest_by_key,
        "upsert_two_batches": upsert_two_batches,
        "upsert_and_compact": upsert_and_compact,
        "merged_versions": merged_versions,
        "snapshot_headings": snapshot_headings,
        "snapshot_network_status": snapshot_network_status,
        "snapshot_daily": snapshot_daily,
        "snapshot_bike_status": snapshot_bike_status,
        "snapshot_bike_situation": snapshot_bike_situation,
        "snapshot_most_charged": snapshot_most_charged,
        "stream_feed_to_topic": stream_feed_to_topic,
        "stream_network_status": stream_network_status,
        "stream_abandoned_count": stream_abandoned_count,
        "stream_history": stream_history,
        "stream_bike_situation": stream_bike_situation,
        "replace_sink_top_range": replace_sink_top_range,
        "stream_station_dimension": stream_station_dimension,
        "stream_backfill": stream_backfill,
        "stream_live_dimension": stream_live_dimension,
        "stream_late_reports": stream_late_reports,
        "stream_quarantine": stream_quarantine,
        "stream_fan_out": stream_fan_out,
        "stream_job_network_status": stream_job_network_status,
        "stream_job_abandoned_count": stream_job_abandoned_count,
        "stream_job_history": stream_job_history,
    }


# --- oracles ------------------------------------------------------------------

_FEEDS = """
WITH raw AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(epoch(date_trunc('minute', ts)) AS INTEGER) AS last_reported
  FROM events),
station AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id,
         CAST(10 + c_custkey % 20 AS INTEGER) AS capacity, c_name AS station_name
  FROM customer),
status AS (
  SELECT CASE WHEN user_id % 50 = 7 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS station_id,
         CAST(k % (11 + user_id % 20) AS INTEGER) AS num_bikes_available,
         CAST(10 + user_id % 20 - k % (11 + user_id % 20) AS INTEGER) AS num_docks_available,
         last_reported, date_trunc('minute', ts) AS "timestamp"
  FROM raw),
bike AS (
  SELECT CAST(event_id % greatest(1, (SELECT count(*) FROM events) // 25) AS VARCHAR) AS bike_id,
         CASE WHEN event_type = 'error' THEN '' WHEN user_id % 50 = 7 THEN 'x' || user_id
              ELSE CAST(user_id AS VARCHAR) END AS station_id,
         last_reported, date_trunc('minute', ts) AS "timestamp",
         k % 3 = 0 AS is_reserved, k % 5 = 0 AS is_disabled,
         CAST(floor(value * 100) AS INTEGER) AS current_range_meters
  FROM raw)
"""

_NETWORK_STATUS = """
SELECT CAST("timestamp" AS DATE) AS day, "timestamp",
       CAST(count(*) FILTER (num_bikes_available = 0) AS BIGINT) AS empty_count,
       CAST(count(*) FILTER (num_bikes_available >= capacity - 3) AS BIGINT) AS saturation_count,
       CAST(count(*) FILTER (num_bikes_available = capacity) AS BIGINT) AS full_count,
       CAST(sum(num_docks_available) AS BIGINT) AS total_docks_available,
       CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes_available
FROM status JOIN station USING (station_id) GROUP BY "timestamp"
"""

_ABANDONED_COUNT = """
SELECT CAST("timestamp" AS DATE) AS day, "timestamp",
       CAST(count(*) AS BIGINT) AS abandoned_bikes_count
FROM bike WHERE station_id = '' GROUP BY "timestamp"
"""

_BIKE_SITUATION = """
SELECT "timestamp", bike_id,
       CASE WHEN is_reserved AND is_disabled THEN 'BOTH'
            WHEN is_reserved THEN 'RESERVED' ELSE 'DISABLED' END AS situation,
       station_name
FROM bike JOIN station USING (station_id) WHERE is_reserved OR is_disabled
"""

_LAST_SITUATION = f"""
SELECT * FROM ({_BIKE_SITUATION}) QUALIFY row_number() OVER (
  PARTITION BY bike_id ORDER BY "timestamp" DESC, situation DESC, station_name DESC) = 1
"""

_TOP_RANGE_LATEST = """
SELECT "timestamp", bike_id, station_name, current_range_meters
FROM (SELECT * FROM bike QUALIFY row_number() OVER (
        PARTITION BY bike_id
        ORDER BY last_reported DESC, current_range_meters DESC, station_id DESC) = 1)
JOIN station USING (station_id)
ORDER BY current_range_meters DESC, bike_id LIMIT 3
"""

_DAILY_FIGURES = """
       CAST(avg(num_bikes_available) AS REAL) AS hour_avg_bikes_avail,
       CAST(avg(num_docks_available) AS REAL) AS hour_avg_docks_avail,
       CAST(count(*) FILTER (num_bikes_available = 0) AS BIGINT) AS empty_occurrences_24h,
       CAST(count(*) FILTER (num_docks_available = 0) AS BIGINT) AS full_occurrences_24h,
       TIMESTAMP '2024-02-01 00:00:00' AS computation_timestamp
"""

_LATEST_STATUS = """
SELECT station_id, num_bikes_available, num_docks_available, last_reported
FROM status QUALIFY row_number() OVER (
  PARTITION BY station_id
  ORDER BY last_reported DESC, num_bikes_available DESC, num_docks_available DESC) = 1
"""

_HISTORY = """
SELECT station_id, num_bikes_available, num_docks_available, last_reported, "timestamp",
       CAST("timestamp" AS DATE) AS day, CAST(hour("timestamp") AS INTEGER) AS hour
FROM status
"""

_LATE_REPORTS = f"""
, sliced AS (
  SELECT *, CASE WHEN num_docks_available % 7 = 3 THEN 2 WHEN last_reported < {STREAM_CUT} THEN 0 ELSE 1 END AS batch_id
  FROM status),
reached AS (
  SELECT b.batch_id, max(s."timestamp") - INTERVAL 10 MINUTE AS watermark
  FROM (SELECT DISTINCT batch_id FROM sliced) b JOIN sliced s ON s.batch_id < b.batch_id GROUP BY b.batch_id)
SELECT station_id, num_bikes_available, num_docks_available, last_reported, "timestamp", watermark,
       CAST(batch_id AS BIGINT) AS batch_id
FROM sliced JOIN reached USING (batch_id) WHERE "timestamp" <= watermark
"""

_QUARANTINE = """
, message AS (
  SELECT *, '{"station_id":"' || station_id || '","num_bikes_available":' || num_bikes_available ||
         ',"num_docks_available":' || num_docks_available || ',"last_reported":' || last_reported || '}' AS whole
  FROM status)
SELECT CASE WHEN num_bikes_available = 0 THEN 'not JSON' WHEN num_docks_available = 0 THEN 'no usable field'
            ELSE 'usable' END AS reason,
       CASE WHEN num_bikes_available = 0 THEN substr(whole, 1, 20)
            WHEN num_docks_available = 0 THEN '{"other":' || num_bikes_available || '}' ELSE whole END AS "text",
       CAST(count(*) AS BIGINT) AS message_count
FROM message GROUP BY ALL
"""

#: The reports of the second slice; those that were in the first as well count twice.
_FAN_OUT = f"""
, late AS (
  SELECT * FROM bike WHERE last_reported >= {STREAM_CUT} OR current_range_meters % 50 = 0),
both_slices AS (
  SELECT * FROM bike WHERE last_reported < {STREAM_CUT} UNION ALL SELECT * FROM late),
top AS ({_TOP_RANGE_LATEST.replace("FROM bike", "FROM late")}),
situations AS ({_LAST_SITUATION.replace("FROM bike", "FROM late")})
SELECT 'bike_status' AS table_name, "timestamp", CAST(NULL AS VARCHAR) AS bike_id,
       CAST(NULL AS VARCHAR) AS detail, abandoned_bikes_count AS number
FROM ({_ABANDONED_COUNT.replace("FROM bike", "FROM both_slices")})
UNION ALL
SELECT 'bike_situation', "timestamp", bike_id, situation || ' at ' || station_name, NULL FROM situations
UNION ALL
SELECT 'most_charged_bikes', "timestamp", bike_id, station_name, NULL FROM top
"""

_STATUS = "SELECT station_id, num_bikes_available, num_docks_available, last_reported FROM status"

_EXPLODED = f"""{_STATUS} UNION ALL
SELECT 'n' || station_id, num_docks_available, num_bikes_available, last_reported FROM status
"""


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL over the driver's tables."""
    daily_by_station = f"""
        SELECT station_id, any_value(station_name) AS station_name, {_DAILY_FIGURES}
        FROM status LEFT JOIN station USING (station_id)"""
    bodies = {
        "network_status": _NETWORK_STATUS,
        "network_status_minute": _NETWORK_STATUS,
        "station_flags": """
            SELECT station_id, num_bikes_available, num_docks_available, last_reported, capacity,
                   CAST(num_bikes_available = capacity AS INTEGER) AS is_full,
                   CAST(num_bikes_available >= capacity - 3 AS INTEGER) AS saturation,
                   CAST(num_bikes_available = 0 AS INTEGER) AS is_empty
            FROM status JOIN station USING (station_id)""",
        "station_dimension": "SELECT station_id, station_name, capacity FROM station",
        "abandoned": """
            SELECT bike_id, station_id, last_reported, is_reserved, is_disabled,
                   current_range_meters
            FROM bike WHERE station_id = ''""",
        "abandoned_count": _ABANDONED_COUNT,
        "bike_situation": _BIKE_SITUATION,
        "top_range": """
            SELECT "timestamp", bike_id, station_name, current_range_meters
            FROM bike JOIN station USING (station_id)
            ORDER BY current_range_meters DESC, bike_id, last_reported DESC, station_id LIMIT 3""",
        "top_range_latest": _TOP_RANGE_LATEST,
        "daily_station_stats": f"{daily_by_station} GROUP BY station_id",
        "daily_from_partials": f"{daily_by_station} GROUP BY station_id",
        "profile_from_sketches": """
            SELECT CAST(count(*) AS BIGINT) AS row_count, min(last_reported) AS first_reported,
                   max(last_reported) AS last_reported, true AS count_is_close, true AS median_is_close
            FROM status""",
        "daily_station_stats_by_hour": f"""
            SELECT station_id, any_value(station_name) AS station_name, {_DAILY_FIGURES},
                   CAST(hour("timestamp") AS INTEGER) AS hour
            FROM status LEFT JOIN station USING (station_id)
            GROUP BY station_id, hour("timestamp")""",
        "daily_job": f"""{daily_by_station}
            WHERE CAST("timestamp" AS DATE) = DATE '{HISTORY_DAY}' GROUP BY station_id""",
        "history_day": f"""{_HISTORY} WHERE CAST("timestamp" AS DATE) = DATE '{HISTORY_DAY}'""",
        "history_day_of_month": f"""{_HISTORY} WHERE day("timestamp") = 5""",
        "history_with_damaged_files": f"""{_HISTORY}
            WHERE CAST("timestamp" AS DATE) <> DATE '{HISTORY_DAY}' OR hour("timestamp") NOT IN (3, 4)""",
        "preview": f"""{_HISTORY} WHERE CAST("timestamp" AS DATE) = DATE '{HISTORY_DAY}'
            ORDER BY last_reported, num_docks_available, num_bikes_available, station_id LIMIT 5""",
        "union_history": """
            SELECT station_id, nullif(num_bikes_available, 0) AS num_bikes_available,
                   num_docks_available, last_reported FROM status""",
        "profile": """
            SELECT CAST(count(*) AS BIGINT) AS row_count, min(last_reported) AS first_reported,
                   max(last_reported) AS last_reported,
                   CAST(count(DISTINCT station_id) AS BIGINT) AS station_count
            FROM status""",
        "decode_status": _STATUS,
        "decode_with_junk": """
            SELECT CAST(count(*) AS BIGINT) AS message_count,
                   CAST(count(*) FILTER (num_bikes_available = 0) AS BIGINT) AS bad_count
            FROM status""",
        "explode_feed": _EXPLODED,
        "latest_by_key": _LATEST_STATUS,
        "upsert_two_batches": _LATEST_STATUS,
        "upsert_and_compact": _LATEST_STATUS,
        "merged_versions": _LATEST_STATUS,
        "snapshot_headings": """
            SELECT station_id AS "Station_Id", station_name AS "Station_Name",
                   capacity AS "Capacity"
            FROM station ORDER BY station_id LIMIT 30""",
        "snapshot_network_status": f"""
            {_NETWORK_STATUS} ORDER BY day DESC, "timestamp" DESC LIMIT 30""",
        "snapshot_daily": f"""
            SELECT * REPLACE (
                round_even(CAST(hour_avg_bikes_avail AS DOUBLE), 2) AS hour_avg_bikes_avail,
                round_even(CAST(hour_avg_docks_avail AS DOUBLE), 2) AS hour_avg_docks_avail)
            FROM ({daily_by_station} GROUP BY station_id) ORDER BY station_id LIMIT 30""",
        "snapshot_bike_status": f"""
            {_ABANDONED_COUNT} ORDER BY day DESC, "timestamp" DESC LIMIT 30""",
        "snapshot_bike_situation": f"""
            {_LAST_SITUATION} ORDER BY bike_id LIMIT 30""",
        "snapshot_most_charged": f"""
            SELECT "timestamp", bike_id, station_name FROM ({_TOP_RANGE_LATEST})""",
        "stream_feed_to_topic": _EXPLODED,
        "stream_network_status": _NETWORK_STATUS,
        "stream_abandoned_count": _ABANDONED_COUNT,
        "stream_history": _HISTORY,
        "stream_bike_situation": _LAST_SITUATION,
        "stream_backfill": _HISTORY,
        "stream_live_dimension": _NETWORK_STATUS.replace(
            "GROUP BY",
            f"WHERE last_reported >= {STREAM_CUT} OR TRY_CAST(station_id AS INTEGER) % 3 <> 0 GROUP BY",
        ),
        "stream_late_reports": _LATE_REPORTS,
        "stream_quarantine": _QUARANTINE,
        "stream_fan_out": _FAN_OUT,
        "stream_job_network_status": _NETWORK_STATUS,
        "stream_job_abandoned_count": _ABANDONED_COUNT,
        "stream_job_history": _HISTORY,
        "replace_sink_top_range": f"""
            SELECT "timestamp", bike_id, station_name FROM ({_TOP_RANGE_LATEST})""",
        "stream_station_dimension": "SELECT station_id, station_name, capacity FROM station",
    }
    core = {name: _FEEDS + body for name, body in bodies.items()}
    whole = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return core | (llm.oracle_sql() if llm else {}) | ({"pipeline": whole} if whole else {})
