"""Usable records and rejected texts of a topic, from one parse, in one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from dockmetrics.sources.feeds import parsed_messages
from dockmetrics.sources.logs import next_log_run, write_logs
from dockmetrics.streaming.sinks import run_of

RECORDS, REJECTED = "records", "rejected"
REJECTED_SCHEMA = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("reason", T.StringType())]
)


def quarantine_sink(
    messages: DataFrame, schema: T.StructType, root: str, checkpoint: str
) -> DataStreamWriter:
    """Append usable records to ``records`` and all other messages, with the reason, to ``rejected``.

    Each message is parsed once and lands in exactly one of the two tables, which show a
    batch together or not at all (``read_log``). A repeated batch adds nothing.
    """
    spark = messages.sparkSession
    run = run_of(spark, checkpoint, lambda: next_log_run(spark, root))

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = parsed_messages(batch, schema).persist()
        try:
            usable = parsed.filter(F.col("reason").isNull()).select("record.*")
            rejected = parsed.filter(F.col("reason").isNotNull()).select("text", "reason")
            write_logs(root, run, batch_id, {RECORDS: usable, REJECTED: rejected})
        finally:
            parsed.unpersist()

    return (
        messages.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"quarantine ({checkpoint})")
        .foreachBatch(store)
    )
