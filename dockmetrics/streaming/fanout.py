"""One read and parse of a topic that feeds several tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from dockmetrics.model import TableSpec
from dockmetrics.sources.files import exists, read_bytes, write_bytes
from dockmetrics.sources.tables import compact, next_run, read_table, write_batch
from dockmetrics.streaming.sinks import COMPACT_EVERY, run_of

#: Stores one micro-batch in a table: (batch, run, batch id).
Store = Callable[[DataFrame, int, int], None]


def fan_out_sink(
    df: DataFrame,
    root: str,
    checkpoint: str,
    tables: Mapping[TableSpec, Store],
    *,
    compact_every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """Store every micro-batch in each of the tables, reading it from its source once.

    ``<checkpoint>/tables/<name>`` holds the last batch that a table has. After a stop
    between two tables the batch is repeated for those that lack it, and only for those.
    """
    spark = df.sparkSession

    def first_run() -> int:
        return max(next_run(spark, root, spec) for spec in tables)

    run = run_of(spark, checkpoint, first_run)

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.persist()
        try:
            for spec, save in tables.items():
                marker = f"{checkpoint.rstrip('/')}/tables/{spec.name}"
                if exists(session, marker) and int(read_bytes(session, marker)) >= batch_id:
                    continue
                save(rows, run, batch_id)
                write_bytes(session, marker, str(batch_id).encode())
                if compact_every and batch_id % compact_every == compact_every - 1:
                    compact(session, root, spec)
        finally:
            rows.unpersist()

    return (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"{', '.join(spec.name for spec in tables)} ({checkpoint})")
        .foreachBatch(store)
    )


def replacing(root: str, spec: TableSpec, prepare: Callable[[DataFrame], DataFrame]) -> Store:
    """The prepared batch becomes the whole table."""

    def save(batch: DataFrame, run: int, batch_id: int) -> None:
        write_batch(prepare(batch), root, spec, run, batch_id)

    return save


def adding(
    root: str, spec: TableSpec, counts: Callable[[DataFrame], DataFrame], measures: list[str]
) -> Store:
    """The batch's measures are added to those that the table has for the same keys.

    ``counts`` gives at most one row per key. Of the table only the partition values that the
    batch touches are read, as they were before it, so a repeated batch is added once.
    Late rows count as well: no state is dropped, so there is no watermark.
    """

    def save(batch: DataFrame, run: int, batch_id: int) -> None:
        spark = batch.sparkSession
        new = counts(batch).dropna(subset=list(spec.keys)).persist()
        try:
            values = None
            if spec.partition:
                values = [str(r[0]) for r in new.select(spec.partition).distinct().collect()]
            before = read_table(spark, root, spec, values, before=(run, batch_id))
            touched = before.join(new.select(*spec.keys), list(spec.keys), "left_semi")
            added = touched.unionByName(new.select(*touched.columns)).groupBy(*spec.keys)
            sums = added.agg(*[F.sum(m).alias(m) for m in measures])
            write_batch(sums, root, spec, run, batch_id, unique=True)
        finally:
            new.unpersist()

    return save
