"""A third of all rows on one station: plans split it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from dockmetrics.operators import latest_by_key, network_status, top_range
from dockmetrics.operators.dimension import fits_broadcast, join_by_slot, join_stations
from dockmetrics.sources import read_history, write_history

T0 = 1_704_067_200
ROWS = 60_000


@pytest.fixture(scope="module")
def status(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "status")
    spark.range(0, ROWS, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id % 500)) as station_id",
        "cast(id % 11 as int) as num_bikes_available",
        "cast(10 - id % 11 as int) as num_docks_available",
        f"cast({T0} + id % 7200 as int) as last_reported",
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dimension(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "dimension")
    spark.range(501).selectExpr(
        "if(id = 500, 'hot', concat('s', id)) as station_id",
        "concat('S', id) as station_name",
        "cast(10 as int) as capacity",
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def settings(spark):
    before = {}

    def change(**conf):
        for name, value in conf.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_join_beyond_broadcast_splits_the_hot_station(settings, status, dimension, rows_of):
    expected = rows_of(network_status(status, dimension))
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="1.1",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
    )
    rollup = network_status(status, dimension)
    assert "SortMergeJoin(skew=true)" in final_plan(rollup)
    assert rows_of(network_status(status, dimension)) == expected


def test_slots_spread_the_hot_station(status, dimension):
    joined = join_by_slot(status, dimension, slots=16)
    assert joined.count() == join_stations(status, dimension).count() == ROWS
    slot = F.pmod(F.xxhash64(*status.columns), F.lit(16))
    slots = status.filter("station_id = 'hot'").groupBy(slot).count()
    sizes = [r["count"] for r in slots.collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * min(sizes)


def test_keep_last_shuffles_one_row_per_key_and_task(status):
    df = latest_by_key(status, ["station_id"], ["last_reported"])
    plan = final_plan(df).split("Initial Plan")[0]
    assert plan.count("partial_max") == 1 and plan.index("partial_max") > plan.index("Exchange")
    assert df.count() == 501


def test_top_range_limits_each_station_before_the_shuffle(settings, status, dimension):
    bikes = status.selectExpr(
        "cast(last_reported as string) as bike_id",
        "station_id",
        "last_reported",
        "num_bikes_available as current_range_meters",
    )
    expected = top_range(bikes, dimension, latest_per_bike=False).collect()
    settings(autoBroadcastJoinThreshold="-1")
    best = top_range(bikes, dimension, latest_per_bike=False)
    assert final_plan(best).count("row_number(), 3, Partial") >= 1
    assert best.collect() == expected


def test_a_hot_hour_is_written_by_several_tasks(spark, settings, status, tmp_path):
    settings(adaptive__advisoryPartitionSizeInBytes="40KB")
    one_hour = status.withColumn("last_reported", F.lit(T0).cast("int"))
    write_history(one_hour, str(tmp_path / "history"))
    files = list((tmp_path / "history").glob("day=2024-01-01/hour=0/*.parquet"))
    assert len(files) > 1
    assert read_history(spark, str(tmp_path / "history")).count() == ROWS


def test_stations_of_small_files_but_many_rows_are_not_broadcast(spark, tmp_path):
    """Files of consecutive ids and one name are many times smaller than their rows in memory."""
    ids = spark.range(30_000).selectExpr("cast(id as string) as station_id", "10 as capacity", "repeat('n', 200) as station_name")
    ids.coalesce(1).write.parquet(f"{tmp_path}/stations")
    stations = spark.read.parquet(f"{tmp_path}/stations")
    facts = spark.range(50).selectExpr("cast(id as string) as station_id", "id as bikes")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4m")
    try:
        assert not fits_broadcast(stations) and fits_broadcast(stations.limit(1000))
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            joined = join_stations(facts.repartition(2), stations)
            assert joined.count() == 50
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
