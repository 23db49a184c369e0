"""The raw station-status history: Parquet by UTC date and hour."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.functions.time import with_event_time, with_partition_keys
from dockmetrics.model import HISTORY_SCHEMA, STATION_STATUS_SCHEMA, require_columns
from dockmetrics.sources.files import children, exists, matching
from dockmetrics.sources.history_log import logged_base, logged_days, logged_files
from dockmetrics.sources.integrity import damaged_files, plain_name

logger = logging.getLogger(__name__)


def history_rows(status: DataFrame) -> DataFrame:
    """Status records with event time and partition columns, as the history stores them."""
    require_columns(status, STATION_STATUS_SCHEMA.fieldNames())
    return with_partition_keys(with_event_time(status)).select(*HISTORY_SCHEMA.fieldNames())


def write_history(status: DataFrame, path: str) -> None:
    """Append a batch of status records to a history folder.

    The rebalance lets the adaptive planner gather an hour's rows into files of
    the advisory size, and split an hour that holds far more than the others.
    A history that a stream commits to may be backfilled this way; readers see both.
    Not so a folder of Spark's own file sink, whose log would hide these files.
    """
    rows = history_rows(status).hint("rebalance", "day", "hour")
    rows.write.mode("append").partitionBy("day", "hour").parquet(path)


def read_history(
    spark: SparkSession,
    path: str,
    day: date | str | None = None,
    *,
    day_of_month: int | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """History rows of one date, or all of them.

    Only the date's files are listed and read: its folders, and what the stream's commits
    name for it. ``day_of_month`` selects that day of every month and year. A folder that
    does not exist reads as empty.

    An unreadable file is an error. ``skip_unreadable`` leaves out the files that
    ``unreadable_files`` names, whole, and logs them.
    """
    files, bad = _files(spark, path, day, day_of_month) if skip_unreadable else ([], [])
    for file in bad:
        logger.warning("skipped unreadable history file %s", file)
    return _history(spark, path, day, day_of_month, files if bad else None)


def unreadable_files(
    spark: SparkSession,
    path: str,
    day: date | str | None = None,
    *,
    day_of_month: int | None = None,
) -> list[str]:
    """The files of a history that cannot be read to their end, checked by the executors."""
    return _files(spark, path, day, day_of_month)[1]


def history_files(
    spark: SparkSession, path: str, day: date | str | None = None, *, day_of_month: int | None = None
) -> list[str]:
    """The files that ``read_history`` would read."""
    files = [plain_name(f) for f in _history(spark, path, day, day_of_month).inputFiles()]
    if day is not None:
        files = [f for f in files if f"/day={parse_day(day)}/" in f]
    if day_of_month is not None:
        files = [f for f in files if f"-{day_of_month:02d}/hour=" in f]
    return files


def read_history_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of some of a history's files."""
    return _history(spark, path, None, None, files)


def _files(
    spark: SparkSession, path: str, day: date | str | None, day_of_month: int | None
) -> tuple[list[str], list[str]]:
    """Readable and unreadable files of the chosen days."""
    files = history_files(spark, path, day, day_of_month=day_of_month)
    bad = damaged_files(spark, files)
    return [f for f in files if f not in bad], [f for f in files if f in bad]


def _history(
    spark: SparkSession,
    path: str,
    day: date | str | None,
    day_of_month: int | None,
    files: list[str] | None = None,
) -> DataFrame:
    """Rows of the chosen days, of the given files only if there are some."""
    if day_of_month is not None and not 1 <= day_of_month <= 31:
        raise ValueError(f"day of month must be 1 to 31, not {day_of_month}")
    path = path.rstrip("/")
    day = None if day is None else parse_day(day)
    base = logged_base(path)
    if files is None:
        folders, logged = _folders(spark, path, day, day_of_month), _logged(spark, path, day, day_of_month)
    else:
        logged = [f for f in files if "/_log/data/" in f]
        folders = [f for f in files if "/_log/data/" not in f]
    parts = []
    if folders:
        reader = spark.read.schema(HISTORY_SCHEMA)
        parts.append((reader if folders == [path] else reader.option("basePath", path)).parquet(*folders))
    if logged:
        rows = spark.read.schema(_LOGGED_SCHEMA).option("basePath", base).parquet(*logged)
        parts.append(rows.select(*HISTORY_SCHEMA.fieldNames()))
    if not parts:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    history = union_history(parts)
    if day is not None:
        history = history.filter(F.col("day") == F.lit(day))
    if day_of_month is not None:
        history = history.filter(F.dayofmonth("day") == day_of_month)
    return history


#: Committed files also stand below the write that they belong to.
_LOGGED_SCHEMA = T.StructType(
    [
        *HISTORY_SCHEMA.fields,
        T.StructField("run", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
    ]
)


def _logged(spark: SparkSession, path: str, day: date | None, day_of_month: int | None) -> list[str]:
    """The committed files of the chosen days."""
    if day is not None:
        return logged_files(spark, path, [f"day={day}"])
    days = logged_days(spark, path)
    if day_of_month is not None:
        days = [d for d in days if d.endswith(f"-{day_of_month:02d}")]
    return logged_files(spark, path, days)


def _folders(
    spark: SparkSession, path: str, day: date | None, day_of_month: int | None
) -> list[str]:
    """The folders that hold the chosen days; none if there are none."""
    if exists(spark, f"{path}/_spark_metadata"):  # a file sink's history is listed by its log
        return [path]
    if day is not None:
        return matching(spark, f"{path}/day={day}")
    if day_of_month is not None:
        return matching(spark, f"{path}/day=*-{day_of_month:02d}")
    return [path] if any(name.startswith("day=") for name in children(spark, path)) else []


def read_day_of_month_history(
    spark: SparkSession, path: str, day: date | str | None = None
) -> DataFrame:
    """A history laid out as ``day=<dd>/hour=<HH>``, with the same columns as ours.

    Such a folder mixes months. The day of month still prunes folders; the date
    itself is taken from each row's event time.
    """
    columns = HISTORY_SCHEMA.fieldNames()
    layout = T.StructType(
        [*HISTORY_SCHEMA.fields[:-2], *(T.StructField(c, T.IntegerType()) for c in columns[-2:])]
    )
    if not exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    history = spark.read.schema(layout).parquet(path)
    if day is None:
        return with_partition_keys(history).select(*columns)
    day = parse_day(day)
    month_days = history.filter(F.col("day") == day.day)
    return with_partition_keys(month_days).select(*columns).filter(F.col("day") == F.lit(day))


def parse_day(day: date | str) -> date:
    """A date, or ValueError for anything that is not ``yyyy-MM-dd``."""
    return day if isinstance(day, date) else date.fromisoformat(day)


def union_history(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of several history frames, columns matched by name; a column that
    some frames lack is null there."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
