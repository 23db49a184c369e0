"""Keep-last and keep-best per key, both reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockmetrics.model import require_columns


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one greatest by ``order``, nulls lowest.

    Rows equal in ``order`` are told apart by their other columns, so the result
    does not depend on how the input is split. An aggregate and not a window:
    each task folds its rows first, so a key that holds much of the data costs
    one row per task in the shuffle.
    """
    require_columns(df, [*keys, *order])
    ranked = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    if not ranked and not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *rest)).alias("_kept"))
    return kept.select(*(c if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key by ``order``.

    The rank filter is applied per task before the shuffle as well (Spark's
    window group limit), so at most ``k`` rows of a key leave any task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") <= k).drop("_rank")
