"""Stream writers; the caller sets a trigger and calls ``start()``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from dockmetrics.model import TableSpec
from dockmetrics.sources.files import exists, read_small, write_small
from dockmetrics.sources.history import history_rows
from dockmetrics.sources.history_log import FOLD_EVERY, commit_batch, next_history_run
from dockmetrics.sources.tables import compact, next_run, write_batch

COMPACT_EVERY = 60

Prepare = Callable[[DataFrame], DataFrame]


def run_of(spark: SparkSession, checkpoint: str, new_run: Callable[[], int]) -> int:
    """The run number that belongs to a checkpoint, new for a new checkpoint.

    Kept inside the checkpoint, so that both are discarded together.
    """
    marker = f"{checkpoint}/table_run"
    if exists(spark, marker):
        return int(read_small(spark, marker))
    run = new_run()
    write_small(spark, marker, str(run))
    return run


@contextmanager
def _adaptive(session: SparkSession) -> Iterator[None]:
    """Adaptive planning for what is done with a micro-batch.

    Spark turns it off in the session of a stateful query, whose own plan is fixed
    by then; without it the few rows of a rollup would be written as one file
    per state partition.
    """
    key = "spark.sql.adaptive.enabled"
    before = session.conf.get(key)
    session.conf.set(key, "true")
    try:
        yield
    finally:
        session.conf.set(key, before)


def _table_sink(
    df: DataFrame,
    root: str,
    spec: TableSpec,
    checkpoint: str,
    prepare: Prepare | None,
    output_mode: str,
    compact_every: int,
    unique: bool = False,
) -> DataStreamWriter:
    spark = df.sparkSession
    run = run_of(spark, checkpoint, lambda: next_run(spark, root, spec))

    def store(batch: DataFrame, batch_id: int) -> None:
        with _adaptive(batch.sparkSession):
            rows = prepare(batch) if prepare else batch
            write_batch(rows, root, spec, run, batch_id, unique=unique)
            if compact_every and batch_id % compact_every == compact_every - 1:
                compact(batch.sparkSession, root, spec)

    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .queryName(f"{spec.name} ({checkpoint})")
        .foreachBatch(store)
    )


def upsert_sink(
    df: DataFrame,
    root: str,
    spec: TableSpec,
    checkpoint: str,
    *,
    prepare: Prepare | None = None,
    output_mode: str = "update",
    compact_every: int = COMPACT_EVERY,
    unique: bool = False,
) -> DataStreamWriter:
    """Merge each micro-batch into a table by key; rows of later batches win.

    ``unique`` spares the fold by key for rows that a rollup already made unique.

    Suits update mode: a rollup sends its running totals again, and they take
    the place of the earlier ones.
    """
    return _table_sink(
        df, root, spec, checkpoint, prepare, output_mode, compact_every, unique
    )


def replace_sink(
    df: DataFrame,
    root: str,
    spec: TableSpec,
    checkpoint: str,
    *,
    prepare: Prepare | None = None,
    output_mode: str = "update",
    compact_every: int = 10,
) -> DataStreamWriter:
    """Make each micro-batch the whole content of a table, even if it is empty.

    ``prepare`` runs on the batch frame, where sorting and fresh reads of other
    tables are possible.
    """
    if spec.mode != "replace":
        raise ValueError(f"{spec.name} is not a replace table")
    return _table_sink(df, root, spec, checkpoint, prepare, output_mode, compact_every)


def history_sink(
    status: DataFrame,
    path: str,
    checkpoint: str,
    *,
    rebalance: bool = False,
    fold_every: int = FOLD_EVERY,
) -> DataStreamWriter:
    """Append status records to the history by UTC date and hour, exactly once.

    Each micro-batch is a commit that names its files under their days, so a reader of a
    day lists that day alone (``history_log``).

    By default tasks write what they read and nothing is shuffled, right while a
    trigger spans an hour or two and has few tasks. A backfill over many days, or
    a topic of very many partitions, would leave a small file per task and hour;
    ``rebalance`` then lets the adaptive planner gather each hour into files of
    the advisory size and split an hour that is far larger than the others.
    """
    spark = status.sparkSession
    run = run_of(spark, checkpoint, lambda: next_history_run(spark, path))

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.hint("rebalance", "day", "hour") if rebalance else batch
        commit_batch(rows, path, run, batch_id, fold_every)

    return (
        history_rows(status)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"history ({checkpoint})")
        .foreachBatch(store)
    )
