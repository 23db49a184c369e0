"""Grouping by event time, exact second or tumbling window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_by_time(df: DataFrame, window: str | None, *measures: Column) -> DataFrame:
    """Aggregate per ``timestamp``, or per window with its start as ``timestamp``."""
    if window is None:
        return df.groupBy("timestamp").agg(*measures)
    grouped = df.groupBy(F.window("timestamp", window).alias("_window")).agg(*measures)
    return grouped.withColumn("timestamp", F.col("_window.start")).drop("_window")
