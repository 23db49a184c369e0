"""What a dashboard shows: the head of every result table."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

from dockmetrics.functions.text import column_label, display_round, table_label
from dockmetrics.model import RESULT_TABLES, TableSpec
from dockmetrics.sources.tables import list_partitions, read_table

logger = logging.getLogger(__name__)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Make every result table a temporary view of its name, for SQL.

    A view shows the writes there were when it was registered.
    """
    for name, spec in RESULT_TABLES.items():
        read_table(spark, root, spec).createOrReplaceTempView(name)
    return list(RESULT_TABLES)


def _head(spark: SparkSession, root: str, spec: TableSpec, n: int) -> DataFrame:
    """The first rows, read here and not later: a damaged file shows only when it is read.

    A table laid out by its first serving column is read value by value, newest first,
    until there are enough rows: the table is listed once, older values are not read.
    """

    def first(rows: DataFrame, most: int) -> list[Row]:
        return display_round(rows.orderBy(*spec.sort_columns()).limit(most)).collect()

    shape = display_round(spark.createDataFrame([], spec.schema)).schema
    if not spec.partition or spec.order[0] != (spec.partition, True):
        return spark.createDataFrame(first(read_table(spark, root, spec), n), shape)
    rows: list[Row] = []
    listing = list_partitions(spark, root, spec)
    for value in reversed(listing.values()):
        if len(rows) >= n:
            break
        rows += first(read_table(spark, root, spec, [value], listing=listing), n - len(rows))
    return spark.createDataFrame(rows, shape)


def snapshot(
    spark: SparkSession,
    root: str,
    tables: Iterable[str] = tuple(RESULT_TABLES),
    n: int = 30,
    *,
    labels: bool = False,
) -> dict[str, DataFrame]:
    """The first ``n`` rows of each table in its serving order, fractions rounded.

    The rows, ``n`` per table at most, pass through the driver. ``labels`` turns table and column names into headings. A table that cannot
    be read is logged and left out.
    """
    shown = {}
    for name in tables:
        try:
            spec = RESULT_TABLES[name]
            head = _head(spark, root, spec, n)
        except (KeyError, PySparkException, Py4JError):
            logger.exception("table %s cannot be read", name)
            continue
        if labels:
            head = head.toDF(*(column_label(c) for c in head.columns))
        shown[table_label(name) if labels else name] = head
    return shown
