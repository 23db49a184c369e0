"""Daily figures and profiles from stored partials that merge.

``update_partials`` reads the history files that are new since the last update, and only
those, and appends per station and hour sums and counts, and per day mergeable sketches.
Both tables and the names of the files they cover are one commit (``sources.logs``), so a
failed update leaves nothing and a repeated one finds nothing new. Any choice of days is
then a sum over partials: a re-run, several days or a day of the month read no history.

Only the newest run of the log counts. After ``fold_every`` updates they are merged into
one, a run of its own; the run before it stays for readers until the next fold. One writer.

Sketches: HyperLogLog of stations (about 1.6 % standard error at the default of 2^12 buckets,
less for few stations) and KLL quantiles of the event second and of available bikes (rank error
about 1.65 %).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.operators.daily import named_figures
from dockmetrics.sources.files import remove_tree
from dockmetrics.sources.history import history_files, parse_day, read_history_files
from dockmetrics.sources.logs import committed, log_path, read_log, write_logs

PARTIALS, SKETCHES, COVERED = "partials", "sketches", "covered"
FOLD_EVERY = 48

_KEYS = ["station_id", "day", "hour"]
_MEASURES = ["bikes_sum", "bikes_count", "docks_sum", "docks_count", "empty_count", "full_count"]
PARTIAL_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        *[T.StructField(name, T.LongType()) for name in _MEASURES],
    ]
)
SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("first_reported", T.IntegerType()),
        T.StructField("last_reported", T.IntegerType()),
        T.StructField("stations", T.BinaryType()),
        T.StructField("seconds", T.BinaryType()),
        T.StructField("bikes", T.BinaryType()),
    ]
)
COVERED_SCHEMA = T.StructType([T.StructField("file", T.StringType())])


def _newest(spark: SparkSession, root: str) -> tuple[int, int]:
    """The newest run and its last batch; run 0 without batches if there is none."""
    return max(committed(spark, root).items(), default=(0, -1))


def _read(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    run, _ = _newest(spark, root)
    rows = read_log(spark, root, name, schema)
    return rows.filter(F.col("run") == run).select(*schema.fieldNames())


def partial_figures(history: DataFrame) -> DataFrame:
    """Sums and counts per station, day and hour; rows without a station are dropped."""
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    return history.filter(F.col("station_id").isNotNull()).groupBy(*_KEYS).agg(
        F.sum(bikes.cast("long")).alias("bikes_sum"),
        F.count(bikes).alias("bikes_count"),
        F.sum(docks.cast("long")).alias("docks_sum"),
        F.count(docks).alias("docks_count"),
        F.count_if(bikes == 0).alias("empty_count"),
        F.count_if(docks == 0).alias("full_count"),
    )


def day_sketches(history: DataFrame) -> DataFrame:
    """Counts and mergeable sketches per day."""
    return history.groupBy("day").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("last_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
        F.hll_sketch_agg("station_id").alias("stations"),
        F.kll_sketch_agg_bigint(F.col("last_reported").cast("long")).alias("seconds"),
        F.kll_sketch_agg_bigint(F.col("num_bikes_available").cast("long")).alias("bikes"),
    )


def update_partials(
    spark: SparkSession,
    root: str,
    history_path: str,
    day: date | str | None = None,
    fold_every: int = FOLD_EVERY,
) -> list[str]:
    """Take in the history files not covered yet, of one day or all; returns their names."""
    files = history_files(spark, history_path, day)
    known = spark.createDataFrame([(f,) for f in files], COVERED_SCHEMA)
    new = known.join(_read(spark, root, COVERED, COVERED_SCHEMA), "file", "left_anti")
    names = sorted(row.file for row in new.collect())
    if not names:
        return []
    run, last = _newest(spark, root)
    history = read_history_files(spark, history_path, names)
    frames = {
        PARTIALS: partial_figures(history),
        SKETCHES: day_sketches(history),
        COVERED: spark.createDataFrame([(n,) for n in names], COVERED_SCHEMA),
    }
    write_logs(root, run, last + 1, frames)
    if last + 2 >= fold_every:
        _fold(spark, root, run)
    return names


def _fold(spark: SparkSession, root: str, run: int) -> None:
    frames = {
        PARTIALS: _merged(_read(spark, root, PARTIALS, PARTIAL_SCHEMA), _KEYS),
        SKETCHES: _merged_sketches(_read(spark, root, SKETCHES, SKETCH_SCHEMA), ["day"]),
        COVERED: _read(spark, root, COVERED, COVERED_SCHEMA),
    }
    write_logs(root, run + 1, 0, frames)
    for name in frames:
        remove_tree(spark, log_path(root, name, run - 1))


def _merged(partials: DataFrame, keys: list[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in _MEASURES])


def _merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        F.min("first_reported").alias("first_reported"),
        F.max("last_reported").alias("last_reported"),
        F.hll_union_agg("stations").alias("stations"),
        F.kll_merge_agg_bigint("seconds").alias("seconds"),
        F.kll_merge_agg_bigint("bikes").alias("bikes"),
    )


def _chosen(rows: DataFrame, days: Sequence[date | str] | None, day_of_month: int | None) -> DataFrame:
    if days is not None:
        rows = rows.filter(F.col("day").isin([parse_day(d) for d in days]))
    if day_of_month is not None:
        rows = rows.filter(F.dayofmonth("day") == day_of_month)
    return rows


def daily_from_partials(
    spark: SparkSession,
    root: str,
    stations: DataFrame,
    computed_at: datetime,
    *,
    days: Sequence[date | str] | None = None,
    day_of_month: int | None = None,
    by_hour: bool = False,
) -> DataFrame:
    """The figures of ``daily_station_stats`` over the chosen days, merged from partials."""
    keys = ["station_id", "hour"] if by_hour else ["station_id"]
    chosen = _chosen(_read(spark, root, PARTIALS, PARTIAL_SCHEMA), days, day_of_month)

    def mean(what: str) -> Column:
        return F.try_divide(F.col(f"{what}_sum").cast("double"), F.col(f"{what}_count")).cast("float")

    figures = _merged(chosen, keys).select(
        *keys,
        mean("bikes").alias("hour_avg_bikes_avail"),
        mean("docks").alias("hour_avg_docks_avail"),
        F.col("empty_count").alias("empty_occurrences_24h"),
        F.col("full_count").alias("full_occurrences_24h"),
    )
    return named_figures(figures, stations, computed_at, by_hour=by_hour)


def profile_from_sketches(
    spark: SparkSession,
    root: str,
    *,
    days: Sequence[date | str] | None = None,
    day_of_month: int | None = None,
    ranks: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """One row like ``profile``, with an estimated ``station_count``, and the ``seconds`` and
    ``bikes`` below which each of ``ranks`` of the rows lie. Reads sketches only."""
    chosen = _chosen(_read(spark, root, SKETCHES, SKETCH_SCHEMA), days, day_of_month)
    # a sum without rows is null
    merged = _merged_sketches(chosen, []).withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    at = F.array(*map(F.lit, ranks))

    def quantiles(name: str) -> Column:  # an empty sketch has none
        found = F.kll_sketch_get_quantile_bigint(name, at)
        return F.when(F.kll_sketch_get_n_bigint(name) > 0, found).alias(name)

    return merged.select(
        "row_count", "first_reported", "last_reported",
        F.hll_sketch_estimate("stations").alias("station_count"),
        quantiles("seconds"),
        quantiles("bikes"),
    )
