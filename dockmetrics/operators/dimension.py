"""Joins with the station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.model import require_columns

HOT_STATION_SLOTS = 32


#: What a row and each of its columns take in a broadcast table besides text.
ROW_BYTES, COLUMN_BYTES = 32, 16


def _limit(stations: DataFrame) -> int:
    return stations.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _exceeds_broadcast(stations: DataFrame) -> bool:
    """Whether the counted rows of ``stations`` are beyond the session's broadcast limit.
    The planner's size of files is that of compressed ones, which may hold many times as much."""
    if stations.isStreaming:
        return False
    text = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in stations.dtypes if kind == "string"]
    row = sum(text, F.lit(ROW_BYTES + COLUMN_BYTES * len(stations.columns)).cast("long"))
    return (stations.agg(F.sum(row)).first()[0] or 0) > max(_limit(stations), 0)


def fits_broadcast(stations: DataFrame) -> bool:
    """Whether ``stations`` is within the session's broadcast limit, both by the
    optimizer's size, the same test the planner makes, and by its counted rows."""
    size = stations._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= _limit(stations) and not _exceeds_broadcast(stations)


def _splits_hot_keys_itself(facts: DataFrame) -> bool:
    conf = facts.sparkSession.conf
    return not facts.isStreaming and (
        conf.get("spark.sql.adaptive.enabled") == "true"
        and conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    )


def join_stations(facts: DataFrame, stations: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``facts`` to the dimension on ``station_id``.

    A dimension within the broadcast limit is broadcast by the planner and facts
    stay where they are. Beyond it, by its counted rows, both sides are shuffled: a batch plan leaves
    hot stations to the adaptive skew join; a stream has no such step, so each
    station's facts are dealt out over fixed slots and its one dimension row is
    repeated per slot.
    """
    require_columns(facts, ["station_id"])
    require_columns(stations, ["station_id"])
    if _splits_hot_keys_itself(facts):
        too_large = _exceeds_broadcast(stations)
        return facts.join(stations.hint("merge") if too_large else stations, "station_id", how)
    if fits_broadcast(stations):
        return facts.join(stations, "station_id", how)
    return join_by_slot(facts, stations, how)


def join_by_slot(
    facts: DataFrame, stations: DataFrame, how: str = "inner", slots: int = HOT_STATION_SLOTS
) -> DataFrame:
    """The same join, with every station spread over ``slots`` tasks.

    The slot is a hash of the whole row: a retried task puts a row where its
    first attempt did.
    """
    slot = F.pmod(F.xxhash64(*facts.columns), F.lit(slots)).cast("int")
    every_slot = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    left = facts.withColumn("_slot", slot)
    right = stations.withColumn("_slot", every_slot)
    return left.join(right.hint("merge"), ["station_id", "_slot"], how).drop("_slot")
