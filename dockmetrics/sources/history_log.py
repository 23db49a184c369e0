"""Commits of streamed history batches, listed by day.

Below a history folder::

    _log/data/run=<r>/batch_id=<b>/attempt=<a>/day=<d>/hour=<h>/*.parquet
    _log/days/day=<d>/commit-<r>-<b>    names of the files of that batch and day
    _log/days/day=<d>/upto-<r>-<b>      names of all files of the day up to that batch

Files count only once an entry names them, so a reader of a day lists that day's entries
and nothing else, and never sees a batch that was not finished. A repeated batch that was
committed adds nothing; one that was not is written anew, under another attempt. Every
``FOLD_EVERY`` entries of a day the writer folds them into one. What a fold covers stays until
the next fold, for readers that listed it. A history has one streaming writer at a time; a new
checkpoint starts a new run.

A batch that spans days is committed day by day: a reader of several days may see it
for some of them while it is being committed.
"""

from __future__ import annotations

import json
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from dockmetrics.sources.files import (
    children,
    exists,
    files_below,
    read_bytes,
    remove_file,
    remove_tree,
    write_bytes,
)

FOLD_EVERY = 24

Version = tuple[int, int]


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/_log/data"


def _days(path: str) -> str:
    return f"{path.rstrip('/')}/_log/days"


def _entries(spark: SparkSession, folder: str, kind: str) -> list[tuple[Version, str]]:
    """Versions and names of a day's entries of one kind, oldest first."""
    found = []
    for name in children(spark, folder):
        if name.startswith(f"{kind}-"):
            run, batch_id = name.split("-")[1:]
            found.append(((int(run), int(batch_id)), name))
    return sorted(found)


def next_history_run(spark: SparkSession, path: str) -> int:
    """A run number above all that the history has seen."""
    runs = [int(name.split("=")[1]) for name in children(spark, _data(path)) if name.startswith("run=")]
    return 1 + max(runs, default=0)


def commit_batch(rows: DataFrame, path: str, run: int, batch_id: int, fold_every: int = FOLD_EVERY) -> None:
    """Write one micro-batch (with ``day`` and ``hour``) and list its files under their days."""
    spark = rows.sparkSession
    folder = f"{_data(path)}/run={run}/batch_id={batch_id}"
    if exists(spark, f"{folder}/_committed"):
        return
    attempt = f"attempt={uuid4().hex}"
    rows.write.partitionBy("day", "hour").parquet(f"{folder}/{attempt}")
    by_day: dict[str, list[str]] = {}
    for name in files_below(spark, f"{folder}/{attempt}", ".parquet"):
        day = name.split("/", 1)[0]
        by_day.setdefault(day, []).append(f"run={run}/batch_id={batch_id}/{attempt}/{name}")
    for day, names in sorted(by_day.items()):
        entries = f"{_days(path)}/{day}"
        write_bytes(spark, f"{entries}/commit-{run}-{batch_id}", json.dumps(names).encode())
        _fold(spark, entries, fold_every)
    write_bytes(spark, f"{folder}/_committed", b"")
    for other in children(spark, folder):
        if other.startswith("attempt=") and other != attempt:
            remove_tree(spark, f"{folder}/{other}")


def _fold(spark: SparkSession, entries: str, fold_every: int) -> None:
    commits, folds = _entries(spark, entries, "commit"), _entries(spark, entries, "upto")
    last = folds[-1][0] if folds else (-1, -1)
    recent = [version for version, _ in commits if version > last]
    if len(recent) < fold_every:
        return
    names = _names(spark, entries)
    run, batch_id = recent[-1]
    write_bytes(spark, f"{entries}/upto-{run}-{batch_id}", json.dumps(names).encode())
    for version, name in [*commits, *folds[:-1]]:
        if version <= last:
            remove_file(spark, f"{entries}/{name}")


def _names(spark: SparkSession, entries: str) -> list[str]:
    """The files that a day's entries name: its last fold and the commits after it."""
    commits, folds = _entries(spark, entries, "commit"), _entries(spark, entries, "upto")
    last, chosen = (folds[-1][0], [folds[-1][1]]) if folds else ((-1, -1), [])
    chosen += [name for version, name in commits if version > last]
    return sorted({f for name in chosen for f in json.loads(read_bytes(spark, f"{entries}/{name}"))})


def logged_days(spark: SparkSession, path: str) -> list[str]:
    """The days that have entries, as ``day=<date>``."""
    return [name for name in children(spark, _days(path)) if name.startswith("day=")]


def logged_files(spark: SparkSession, path: str, days: list[str]) -> list[str]:
    """Full names of the committed files of some days (as ``day=<date>``)."""
    found: list[str] = []
    for day in days:
        entries = f"{_days(path)}/{day}"
        try:
            names = _names(spark, entries)
        except Py4JJavaError:  # folded away between listing and reading
            names = _names(spark, entries)
        found += [f"{_data(path)}/{name}" for name in names]
    return found


def logged_base(path: str) -> str:
    """The folder below which the partition columns of committed files stand."""
    return _data(path)
