"""Result tables on plain Parquet.

A table folder holds one sub-folder per write, ``run=<r>/batch_id=<n>``. A write
replaces its own folder, so repeating it changes nothing. Batch ids restart with
a new stream checkpoint; the run number above them keeps later writes later.
A write counts once its ``_SUCCESS`` marker is there. Each table has one writer.

``base/run=<r>/batch_id=<n>`` is the outcome of folding all writes up to that
one; readers take the newest base and the writes after it.

A table with a ``partition`` column has a folder per value (``day=<d>``) in each
write and base. A folding then holds only the values written since the one before;
readers take each value from its newest base. So neither a fold nor a read of some
values touches the rest of the table.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dockmetrics.model import ARRIVED, TableSpec, conform
from dockmetrics.operators.keyed import latest_by_key
from dockmetrics.sources.files import matching, modified, remove_tree

_VERSION = re.compile(r"run=(\d+)/batch_id=(\d+)")


class Write(NamedTuple):
    run: int
    batch_id: int
    path: str

    @property
    def version(self) -> tuple[int, int]:
        return self.run, self.batch_id


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def write_path(root: str, spec: TableSpec, run: int, batch_id: int) -> str:
    return f"{table_path(root, spec)}/run={run}/batch_id={batch_id}"


def _writes(spark: SparkSession, folder: str) -> list[Write]:
    found = []
    for marker in matching(spark, f"{folder}/run=*/batch_id=*/_SUCCESS"):
        run, batch_id = map(int, _VERSION.search(marker).groups())
        found.append(Write(run, batch_id, marker.rsplit("/", 1)[0]))
    return sorted(found)


def writes(spark: SparkSession, root: str, spec: TableSpec) -> list[Write]:
    """Completed writes, oldest first."""
    return _writes(spark, table_path(root, spec))


def bases(spark: SparkSession, root: str, spec: TableSpec) -> list[Write]:
    """Completed foldings, oldest first."""
    return _writes(spark, f"{table_path(root, spec)}/base")


def next_run(spark: SparkSession, root: str, spec: TableSpec) -> int:
    """A run number above all that the table has seen, completed or not."""
    folders = matching(spark, f"{table_path(root, spec)}/run=*")
    folders += matching(spark, f"{table_path(root, spec)}/base/run=*")
    return 1 + max((int(folder.rsplit("=", 1)[1]) for folder in folders), default=0)


def write_batch(
    df: DataFrame, root: str, spec: TableSpec, run: int, batch_id: int, *, unique: bool = False
) -> None:
    """Store ``df`` as one write of the table, one row per key.

    ``unique`` says that it has one already, as an aggregate by the key does.

    Rows with a null key are left out: no keyed table can hold them. The last row
    of a key by the table's version columns, then by arrival, counts. Copies are
    folded before the shuffle, and planned adaptively the files are as
    few as the rows allow, however many tasks computed them.
    """
    arrival = [c for c in df.columns if c == ARRIVED]
    rows = conform(df, spec, *arrival).dropna(subset=list(spec.keys))
    if not unique:
        rows = latest_by_key(rows, spec.keys, [*spec.version, *arrival])
    rows = rows.drop(ARRIVED)
    _save(rows, spec, write_path(root, spec, run, batch_id))


def _save(rows: DataFrame, spec: TableSpec, path: str) -> None:
    if not spec.partition:
        rows.write.mode("overwrite").parquet(path)
        return
    # gathered by value, else every task would leave a file for each of them
    rows = rows.hint("rebalance", spec.partition)
    rows.write.mode("overwrite").partitionBy(spec.partition).parquet(path)


def ensure_tables(spark: SparkSession, root: str, specs: Iterable[TableSpec]) -> None:
    """Create the tables that do not exist yet, empty."""
    for spec in specs:
        if not writes(spark, root, spec) and not bases(spark, root, spec):
            write_batch(spark.createDataFrame([], spec.schema), root, spec, 0, 0)


def upsert(df: DataFrame, root: str, spec: TableSpec) -> None:
    """Merge a batch frame into a table by key, in a run of its own."""
    write_batch(df, root, spec, next_run(df.sparkSession, root, spec), 0)


def _read_parts(spark: SparkSession, folder: str, spec: TableSpec, paths: list[str]) -> DataFrame:
    versioned = T.StructType(
        [
            *spec.schema.fields,
            T.StructField("run", T.IntegerType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    return spark.read.schema(versioned).option("basePath", folder).parquet(*paths)


class Part(NamedTuple):
    """One partition value's folder within a write or base."""

    version: tuple[int, int]
    value: str
    path: str


def _value_parts(spark: SparkSession, folder: str, spec: TableSpec, done: list[Write]) -> list[Part]:
    """The partition folders of completed writes, oldest first."""
    known = {write.version for write in done}
    found = []
    for path in matching(spark, f"{folder}/run=*/batch_id=*/{spec.partition}=*"):
        version = tuple(map(int, _VERSION.search(path).groups()))
        if version in known:
            found.append(Part(version, path.rsplit("=", 1)[1], path))
    return sorted(found)


class Listing(NamedTuple):
    """The partition folders to read: each value's newest base, and the writes after the fold."""

    folded: dict[str, str]
    recent: list[Part]

    def values(self) -> list[str]:
        return sorted({*self.folded, *(part.value for part in self.recent)})

    def paths(self, values: Iterable[str] | None = None) -> tuple[list[str], list[str]]:
        chosen = set(self.values() if values is None else values)
        return (
            [path for value, path in self.folded.items() if value in chosen],
            [part.path for part in self.recent if part.value in chosen],
        )


def list_partitions(
    spark: SparkSession, root: str, spec: TableSpec, before: tuple[int, int] | None = None
) -> Listing:
    """What a partitioned table holds, for any number of reads of it."""
    folder = table_path(root, spec)
    folded = bases(spark, root, spec)
    newest = folded[-1].version if folded else (-1, -1)
    base_of = {p.value: p.path for p in _value_parts(spark, f"{folder}/base", spec, folded)}
    late = [w for w in writes(spark, root, spec) if w.version > newest and _precedes(w, before)]
    return Listing(base_of, _value_parts(spark, folder, spec, late))


def partition_values(spark: SparkSession, root: str, spec: TableSpec) -> list[str]:
    """The values of the partition column that the table holds, in ascending order."""
    return list_partitions(spark, root, spec).values()


def _precedes(write: Write, before: tuple[int, int] | None) -> bool:
    return before is None or write.version < before


def read_table(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    values: Iterable[str] | None = None,
    *,
    before: tuple[int, int] | None = None,
    listing: Listing | None = None,
) -> DataFrame:
    """Current rows of a table; empty if nothing was written yet.

    Filters on key columns reach the Parquet scan. ``values`` of the partition column
    restrict the read to their folders. ``before`` leaves out the write of that
    version and later ones, for a writer that adds to what was there. ``listing`` is one
    made before, which is not made again.
    """
    folder = table_path(root, spec)
    if spec.partition:
        listing = listing or list_partitions(spark, root, spec, before)
        folded, done = listing.paths(values)
    else:
        late = [w for w in writes(spark, root, spec) if _precedes(w, before)]
        newest = bases(spark, root, spec)[-1:]
        if spec.mode == "replace":
            late, newest = late[-1:], []
        elif newest:
            late = [w for w in late if w.version > newest[0].version]
        folded, done = [w.path for w in newest], [w.path for w in late]
    parts = [_read_parts(spark, f"{folder}/base", spec, folded)] if folded else []
    if done:
        parts.append(_read_parts(spark, folder, spec, done))
    if not parts:
        return spark.createDataFrame([], spec.schema)
    # a base has one row per key, and so has a write
    if not done or (not folded and len(done) == 1):
        return parts[0].select(*spec.columns)
    versions = reduce(DataFrame.unionByName, parts)
    order = ["run", "batch_id", *spec.version]
    return latest_by_key(versions, spec.keys, order).select(*spec.columns)


#: How long files stay that newer ones replace; longer than any job that reads them.
RETAIN_SECONDS = 6 * 3600


def compact(
    spark: SparkSession, root: str, spec: TableSpec, retain_seconds: float = RETAIN_SECONDS
) -> None:
    """Fold what was written so far, and drop what has been replaced for long enough.

    Readers keep the files they listed: a write stays until the folding that covers
    it, and a folding until the next one, is ``retain_seconds`` old. A replace
    table keeps each write until the next is that old. Only the table's writer may
    call this.
    """
    done = writes(spark, root, spec)
    if spec.mode == "replace":
        old = time.time() - retain_seconds
        for write, following in zip(done, done[1:]):
            if modified(spark, f"{following.path}/_SUCCESS") <= old:
                remove_tree(spark, write.path)
        return
    folded = bases(spark, root, spec)
    if done and (not folded or done[-1].version > folded[-1].version):
        newest = done[-1]
        target = f"{table_path(root, spec)}/base/run={newest.run}/batch_id={newest.batch_id}"
        touched = None
        if spec.partition:
            recent = [w for w in done if not folded or w.version > folded[-1].version]
            touched = {p.value for p in _value_parts(spark, table_path(root, spec), spec, recent)}
        _save(read_table(spark, root, spec, touched), spec, target)
        folded = bases(spark, root, spec)
    old = time.time() - retain_seconds
    aged = [b for b in folded if modified(spark, f"{b.path}/_SUCCESS") <= old]
    if not aged:
        return
    for write in done:
        if write.version <= aged[-1].version:
            remove_tree(spark, write.path)
    if not spec.partition:
        for base in aged[:-1]:
            remove_tree(spark, base.path)
        return
    # of each value the newest aged base stays; bases without any value left go
    parts = _value_parts(spark, f"{table_path(root, spec)}/base", spec, aged)
    current = {p.value: p for p in parts}
    for part in parts:
        if current[part.value] != part:
            remove_tree(spark, part.path)
    held = {part.version for part in current.values()}
    for base in aged[:-1]:
        if base.version not in held:
            remove_tree(spark, base.path)
