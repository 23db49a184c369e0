"""The batch layer: one day's figures per station."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from dockmetrics.model import BATCH_STATION_STATUS, STATION_DIMENSION
from dockmetrics.operators.daily import daily_station_stats
from dockmetrics.sources.history import parse_day, read_history, unreadable_files
from dockmetrics.sources.tables import compact, ensure_tables, read_table, upsert

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class DailyRun:
    """What a daily run read: rows, first and last event second, and the files it left
    out because they could not be read."""

    row_count: int
    first_reported: int | None = None
    last_reported: int | None = None
    skipped_files: tuple[str, ...] = ()


def preview(df: DataFrame, n: int = 5) -> list[Row]:
    """The first rows, for a log line; the schema is ``df.schema.treeString()``."""
    return df.limit(n).collect()


def run_daily_job(
    spark: SparkSession,
    day: date | str | None = None,
    *,
    day_of_month: int | None = None,
    root: str,
    history_path: str,
    computed_at: datetime,
    skip_unreadable: bool = False,
) -> DailyRun:
    """Compute the day's figures and merge them into ``batch_station_status``.

    ``day_of_month`` instead of ``day`` takes that day of every month there is.
    ValueError if neither or both are given or either is no such day. Nothing is
    written for a day without rows. An unreadable history file fails the run, unless
    ``skip_unreadable``: then the result names what was left out. The counts are observed while the figures are
    computed, in the same scan.
    """
    if (day is None) == (day_of_month is None):
        raise ValueError("give either a day or a day of the month")
    if day is not None:
        day = parse_day(day)
    skipped = (
        unreadable_files(spark, history_path, day, day_of_month=day_of_month)
        if skip_unreadable
        else []
    )
    history = read_history(
        spark, history_path, day, day_of_month=day_of_month, skip_unreadable=bool(skipped)
    )
    chosen = day or f"day {day_of_month} of the month"
    first_rows = preview(history)
    if not first_rows:
        logger.warning("no history for %s in %s", chosen, history_path)
        return DailyRun(0, skipped_files=tuple(skipped))
    logger.info("%s\nfirst rows: %s", history.schema.treeString(), first_rows)

    ensure_tables(spark, root, [BATCH_STATION_STATUS, STATION_DIMENSION])
    seen = Observation("daily history")
    observed = history.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.min("last_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
    )
    stations = read_table(spark, root, STATION_DIMENSION)
    upsert(daily_station_stats(observed, stations, computed_at), root, BATCH_STATION_STATUS)
    compact(spark, root, BATCH_STATION_STATUS)
    result = DailyRun(**seen.get, skipped_files=tuple(skipped))
    logger.info("figures of %s written: %s", chosen, result)
    return result
