"""Status rollup over a live station dimension, and the reports that come too late for it.

Two queries in a row. The first reads the dimension anew in every micro-batch, joins its
capacities to the reports and passes them on as files; the second keeps the totals in state.
A station added in mid-stream counts from the next batch on, without a restart.

The first query also knows the watermark, the latest event time of all earlier batches less
the delay, and stores the reports behind it in a table of their own, with their batch. It
keeps that time beside its checkpoint, per batch, so a repeated batch is cut alike. Nothing that it passes on
is late for the second query, whose watermark comes from fewer rows. So what the totals
count and the late table add up to the input. (Spark's own stateful operators judge a batch
by the watermark of the batch before it, so the plain rollup still counts some of these.)
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from dockmetrics.functions.time import with_event_time
from dockmetrics.model import STATION_STATUS_SCHEMA
from dockmetrics.operators.dimension import join_stations
from dockmetrics.sources.files import exists, move, read_bytes, remove_file, write_bytes
from dockmetrics.sources.logs import next_log_run, read_log, write_logs
from dockmetrics.streaming.sinks import run_of

LATE_REPORTS = "late_reports"
LATE_SCHEMA = T.StructType(
    [
        *STATION_STATUS_SCHEMA.fields,
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("watermark", T.TimestampType()),
    ]
)
ENRICHED_SCHEMA = T.StructType(
    [
        *STATION_STATUS_SCHEMA.fields,
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("capacity", T.IntegerType()),
    ]
)

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def delay_seconds(text: str) -> int:
    """Seconds of a watermark delay such as ``"10 minutes"``."""
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", text)
    if not match:
        raise ValueError(f"no delay: {text!r}; write a number and seconds, minutes, hours or days")
    return int(match[1]) * _UNITS[match[2]]


class EventTimes:
    """The latest event time up to each batch, in microseconds, beside a checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.folder = spark, f"{checkpoint.rstrip('/')}/event_times"

    def before(self, batch_id: int) -> int | None:
        path = f"{self.folder}/{batch_id - 1}"
        if batch_id == 0 or not exists(self.spark, path):
            return None
        text = read_bytes(self.spark, path).decode()
        return int(text) if text else None

    def store(self, batch_id: int, latest: int | None) -> None:
        known = [t for t in (self.before(batch_id), latest) if t is not None]
        write_bytes(self.spark, f"{self.folder}/{batch_id}", str(max(known)).encode() if known else b"")
        remove_file(self.spark, f"{self.folder}/{batch_id - 2}")


def split_late(rows: DataFrame, watermark_micros: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows on time and rows at or behind the watermark; rows without an event time are on time."""
    bound = F.timestamp_micros(F.lit(watermark_micros).cast("long"))
    late = F.coalesce(F.col("timestamp") <= bound, F.lit(False))
    return rows.filter(~late), rows.filter(late).withColumn("watermark", bound)


def enrich_sink(
    status: DataFrame,
    stations: Callable[[SparkSession], DataFrame],
    folder: str,
    checkpoint: str,
    *,
    watermark: str = "10 minutes",
) -> DataStreamWriter:
    """Reports with their station's capacity, passed on below ``<folder>/enriched``; late ones
    go to ``late_reports``. ``stations`` is called for every batch. Reports of stations
    unknown at that time are left out.

    A batch is passed on by renaming its folder, once, so the reader sees each batch exactly once.
    """
    spark, delay = status.sparkSession, delay_seconds(watermark) * 1_000_000
    run = run_of(spark, checkpoint, lambda: next_log_run(spark, folder))
    base = folder.rstrip("/")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        times = EventTimes(session, checkpoint)
        latest = times.before(batch_id)
        rows = with_event_time(batch.select(*STATION_STATUS_SCHEMA.fieldNames())).persist()
        try:
            kept, late = split_late(rows, None if latest is None else latest - delay)
            write_logs(f"{base}/side", run, batch_id, {LATE_REPORTS: late.select(*LATE_SCHEMA.fieldNames())})
            target = f"{base}/enriched/run={run}/batch_id={batch_id}"
            if not exists(session, target):
                known = stations(session).select("station_id", "capacity")
                staged = f"{base}/_staged/{run}-{batch_id}"
                enriched = join_stations(kept, known).select(*ENRICHED_SCHEMA.fieldNames())
                enriched.write.mode("overwrite").parquet(staged)
                move(session, staged, target)
            times.store(batch_id, rows.agg(F.max(F.unix_micros("timestamp"))).first()[0])
        finally:
            rows.unpersist()

    return (
        status.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"enriched status ({checkpoint})")
        .foreachBatch(store)
    )


def read_enriched(spark: SparkSession, folder: str, *, clean: bool = False) -> DataFrame:
    """What ``enrich_sink`` passes on, as a stream. ``clean`` removes files once they were counted."""
    reader = spark.readStream.schema(ENRICHED_SCHEMA).option("recursiveFileLookup", "true")
    reader = reader.option("maxFileAge", "36500d").option("cleanSource", "delete" if clean else "off")
    return reader.parquet(f"{folder.rstrip('/')}/enriched")


def read_late_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The reports that came too late, with the watermark and the batch that they came in."""
    return read_log(spark, f"{folder.rstrip('/')}/side", LATE_REPORTS, LATE_SCHEMA)
