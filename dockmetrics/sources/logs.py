"""Append-only tables that a stream writes batch by batch, several at once.

``<root>/<name>/run=<r>/batch_id=<b>`` holds the rows of one micro-batch in one table.
``<root>/_commits/run=<r>`` names the run's last batch whose rows are complete in all tables.
Batches of a run follow one another without gaps, so readers take those up to that number:
a filter on partition columns. A batch shows in all tables or in none; a repeated one
replaces its own folders, or is skipped if it was complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.sources.files import children, read_bytes, write_bytes


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def log_path(root: str, name: str, run: int) -> str:
    return f"{root.rstrip('/')}/{name}/run={run}"


def committed(spark: SparkSession, root: str) -> dict[int, int]:
    """The last complete batch of each run."""
    runs = [name for name in children(spark, _commits(root)) if name.startswith("run=")]
    return {int(name[4:]): int(read_bytes(spark, f"{_commits(root)}/{name}")) for name in runs}


def next_log_run(spark: SparkSession, root: str) -> int:
    """A run number above all that the tables have seen, complete or not."""
    names = [name for table in children(spark, root) for name in children(spark, f"{root}/{table}")]
    return 1 + max((int(n[4:]) for n in names if n.startswith("run=")), default=0)


def is_committed(spark: SparkSession, root: str, run: int, batch_id: int) -> bool:
    return committed(spark, root).get(run, -1) >= batch_id


def write_logs(root: str, run: int, batch_id: int, frames: dict[str, DataFrame]) -> None:
    """Store one batch in the tables named, then commit it for all of them."""
    root = root.rstrip("/")
    spark = next(iter(frames.values())).sparkSession
    if is_committed(spark, root, run, batch_id):
        return
    for name, rows in frames.items():
        rows.write.mode("overwrite").parquet(f"{log_path(root, name, run)}/batch_id={batch_id}")
    write_bytes(spark, f"{_commits(root)}/run={run}", str(batch_id).encode())


def read_log(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The complete batches of a table, with ``run`` and ``batch_id``; empty if there is none."""
    versioned = T.StructType(
        [*schema.fields, T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType())]
    )
    last = committed(spark, root)
    if not last:
        return spark.createDataFrame([], versioned)
    rows = spark.read.schema(versioned).parquet(f"{root.rstrip('/')}/{name}")
    complete = [(F.col("run") == run) & (F.col("batch_id") <= batch) for run, batch in sorted(last.items())]
    return rows.filter(reduce(lambda a, b: a | b, complete))
