"""Keyed tables with numbered snapshots and merges that rewrite only what they touch.

``<root>/<name>/_versions/<n>`` lists the live files of version n with the range of their first
key column and their rows. A reader pins a version and lists nothing else. A writer merges
against the version it read and commits the next number, which a store gives out once: of
two writers one finds it taken, reads the new version and merges again, so neither loses rows.

Files hold disjoint stretches of the key. A merge reads and replaces the files whose stretch
holds a key of the batch, as far as the ranges of the batch's own sorted parts tell; the
others stay as they are. Replaced files stay until ``vacuum``, for readers of older versions.

For tables whose single writer streams small batches the append layout of ``tables`` is cheaper;
this one suits large tables that several jobs merge into.
"""

from __future__ import annotations

import json
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmetrics.model import TableSpec, conform
from dockmetrics.operators.keyed import latest_by_key
from dockmetrics.sources.files import children, create_new, exists, read_bytes, remove_file, remove_tree

#: Rows that a file should hold at most.
ROWS_PER_FILE = 1_000_000
#: Sorted parts of a batch whose key ranges decide which files it touches.
BATCH_PARTS = 64
ATTEMPTS = 20


class LiveFile(NamedTuple):
    """A data file, relative to the table, with the first key column's range as text."""

    path: str
    low: str
    high: str
    rows: int


def _table(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def current_version(spark: SparkSession, root: str, spec: TableSpec) -> int:
    """The newest version; 0 is the empty table."""
    names = [n for n in children(spark, f"{_table(root, spec)}/_versions") if n.isdigit()]
    return max(map(int, names), default=0)


def live_files(spark: SparkSession, root: str, spec: TableSpec, version: int) -> list[LiveFile]:
    if version == 0:
        return []
    content = read_bytes(spark, f"{_table(root, spec)}/_versions/{version:010d}")
    return [LiveFile(*entry) for entry in json.loads(content)]


def read_version(
    spark: SparkSession, root: str, spec: TableSpec, version: int | None = None
) -> DataFrame:
    """The rows of a version, by default of the newest one."""
    version = current_version(spark, root, spec) if version is None else version
    return _read(spark, root, spec, live_files(spark, root, spec, version))


def _read(spark: SparkSession, root: str, spec: TableSpec, files: list[LiveFile]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], spec.schema)
    return spark.read.schema(spec.schema).parquet(*[f"{_table(root, spec)}/{f.path}" for f in files])


def merge(
    df: DataFrame, root: str, spec: TableSpec, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Merge a batch by key, its rows taking the place of older ones; returns the new version.

    Of several batch rows of a key the last by the table's version columns counts. Rows with
    a null key are left out.
    """
    spark = df.sparkSession
    batch = latest_by_key(conform(df, spec).dropna(subset=list(spec.keys)), spec.keys, spec.version)
    batch = batch.persist()
    try:
        ranges, count = _key_ranges(batch, spec)
        if not count:
            return current_version(spark, root, spec)
        for _ in range(ATTEMPTS):
            version = current_version(spark, root, spec)
            files = live_files(spark, root, spec, version)
            touched = [f for f in files if any(low <= f.high and f.low <= high for low, high in ranges)]
            older = _read(spark, root, spec, touched).withColumn("_newer", F.lit(0))
            both = older.unionByName(batch.withColumn("_newer", F.lit(1)))
            merged = latest_by_key(both, spec.keys, ["_newer"]).drop("_newer")
            total = count + sum(f.rows for f in touched)
            written = _write(merged, root, spec, -(-total // rows_per_file))
            kept = [f for f in files if f not in touched]
            if _commit(spark, root, spec, version + 1, sorted([*kept, *written], key=lambda f: f.low)):
                return version + 1
            remove_tree(spark, f"{_table(root, spec)}/{written[0].path.rsplit('/', 1)[0]}")
        raise RuntimeError(f"{spec.name}: other writers took {ATTEMPTS} versions in a row")
    finally:
        batch.unpersist()


def _key(spec: TableSpec):
    return F.col(spec.keys[0]).cast("string")


def _key_ranges(batch: DataFrame, spec: TableSpec) -> tuple[list[tuple[str, str]], int]:
    """First and last key of each sorted part of a batch, and its rows."""
    keys = batch.select(_key(spec).alias("key")).repartitionByRange(BATCH_PARTS, "key")
    parts = keys.groupBy(F.spark_partition_id()).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n")
    )
    found = parts.collect()  # at most BATCH_PARTS rows
    return [(r.low, r.high) for r in found], sum(r.n for r in found)


def _write(rows: DataFrame, root: str, spec: TableSpec, files: int) -> list[LiveFile]:
    """Files of disjoint key stretches in a folder of their own."""
    spark, folder = rows.sparkSession, f"data/{uuid4().hex}"
    # only by the first key column: a stretch of it never lies in two files
    rows.repartitionByRange(max(files, 1), _key(spec)).write.parquet(f"{_table(root, spec)}/{folder}")
    back = spark.read.schema(spec.schema).parquet(f"{_table(root, spec)}/{folder}")
    stats = back.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.min(_key(spec)).alias("low"), F.max(_key(spec)).alias("high"), F.count(F.lit(1)).alias("n")
    )
    return [LiveFile(f"{folder}/{r.name}", r.low, r.high, r.n) for r in stats.collect()]


def _commit(spark: SparkSession, root: str, spec: TableSpec, version: int, files: list[LiveFile]) -> bool:
    """Whether this writer got the version."""
    path = f"{_table(root, spec)}/_versions/{version:010d}"
    return create_new(spark, path, json.dumps(files).encode())


def vacuum(spark: SparkSession, root: str, spec: TableSpec, keep_versions: int = 10) -> None:
    """Drop all but the newest versions, and the folders that none of those uses. Not while
    another writer merges: its files are not listed yet."""
    table, newest = _table(root, spec), current_version(spark, root, spec)
    first = max(newest - keep_versions + 1, 1)
    used = {
        f.path.rsplit("/", 1)[0]
        for version in range(first, newest + 1)
        if exists(spark, f"{table}/_versions/{version:010d}")
        for f in live_files(spark, root, spec, version)
    }
    for name in children(spark, f"{table}/_versions"):
        if name.isdigit() and int(name) < first:
            remove_file(spark, f"{table}/_versions/{name}")
    for name in children(spark, f"{table}/data"):
        if f"data/{name}" not in used:
            remove_tree(spark, f"{table}/data/{name}")
