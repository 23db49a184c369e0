"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmetrics.session import shared_folder
from dockmetrics.sources.files import remove_tree

#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = "[\\x20\\x09-\\x0D]"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor never repeats what came before, and a
    result that is read more than once is computed once.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[written] = path
    return written


#: The folder of each table that ``materialize`` returned.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialize`` wrote, once all that was derived from them is
    written too; any other DataFrame is left alone."""
    for table in tables:
        if path := _folders.pop(table, None):
            remove_tree(table.sparkSession, path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands the library to the executors' Python, once per application; a cluster on
    which it is installed needs no such call."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def release_memory() -> None:
    """Gives freed memory back to the system after a batch. Python workers serve task after
    task, and what one of them keeps adds to the executor's memory for good."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def whole_text(column: str | Column) -> Column:
    """The text, a null one as an empty one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def row_hash(column: str | Column) -> Column:
    """A 64-bit hash of a text that tells rows of one id apart."""
    return F.xxhash64(whole_text(column))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
