"""Daily partials and sketches: what an update reads, and what merging gives."""

from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dockmetrics.operators import daily_station_stats, profile
from dockmetrics.plans import partials
from dockmetrics.plans.partials import daily_from_partials, profile_from_sketches, update_partials
from dockmetrics.sources import history_rows, read_history, write_history
from dockmetrics.sources.history_log import commit_batch
from test_history import STATUS, second

NOW = datetime(2024, 3, 1, tzinfo=UTC)


@pytest.fixture
def stations(spark):
    rows = [(f"s{i}", f"Station {i}", 10) for i in range(5)]
    return spark.createDataFrame(rows, "station_id string, station_name string, capacity int")


def reports(spark, day, n, seed=0):
    start = second(f"{day}T00:00:00")
    rows = [(f"s{(i + seed) % 7}", (3 * i + seed) % 11, (5 * i) % 11, start + 977 * i % 86400) for i in range(n)]
    return spark.createDataFrame([*rows, (None, 1, 1, start), ("s1", None, None, start)], STATUS)


def expected(rows_of, history, stations, by_hour=False):
    return rows_of(daily_station_stats(history, stations, NOW, by_hour=by_hour))


def test_updates_read_new_files_only_and_merge_to_the_whole(spark, tmp_path, stations, rows_of):
    path, root = f"{tmp_path}/history", f"{tmp_path}/partials"
    assert update_partials(spark, root, path) == []
    assert daily_from_partials(spark, root, stations, NOW).count() == 0
    write_history(reports(spark, "2024-01-05", 40), path)
    first = update_partials(spark, root, path)
    assert len(first) == len(list(Path(path).glob("day=*/*/*.parquet")))
    assert update_partials(spark, root, path) == []
    write_history(reports(spark, "2024-01-05", 30, seed=2), path)
    write_history(reports(spark, "2024-02-05", 25, seed=1), path)
    commit_batch(history_rows(reports(spark, "2024-02-06", 20, seed=3)), path, 1, 0)
    second_day = update_partials(spark, root, path, "2024-02-05")
    assert second_day and all("/day=2024-02-05/" in f for f in second_day)
    rest = update_partials(spark, root, path)
    assert rest and not set(rest) & {*first, *second_day}

    whole = read_history(spark, path)
    for by_hour in (False, True):
        merged = daily_from_partials(spark, root, stations, NOW, by_hour=by_hour)
        assert rows_of(merged) == expected(rows_of, whole, stations, by_hour)
    one = daily_from_partials(spark, root, stations, NOW, days=["2024-01-05"])
    assert rows_of(one) == expected(rows_of, read_history(spark, path, "2024-01-05"), stations)
    some = daily_from_partials(spark, root, stations, NOW, days=["2024-01-05", "2024-02-06"])
    assert rows_of(some) == expected(rows_of, whole.filter("day <> '2024-02-05'"), stations)
    month_days = daily_from_partials(spark, root, stations, NOW, day_of_month=5)
    assert rows_of(month_days) == expected(rows_of, read_history(spark, path, day_of_month=5), stations)


def test_folded_updates_give_the_same_and_go(spark, tmp_path, stations, rows_of):
    path, root = f"{tmp_path}/history", f"{tmp_path}/partials"
    for i in range(5):
        write_history(reports(spark, f"2024-01-0{1 + i % 2}", 10, seed=i), path)
        update_partials(spark, root, path, fold_every=2)
    assert update_partials(spark, root, path) == []
    whole = read_history(spark, path)
    assert rows_of(daily_from_partials(spark, root, stations, NOW)) == expected(rows_of, whole, stations)
    shown = profile_from_sketches(spark, root).first()
    exact = profile(whole).first()
    assert shown[:3] == exact[:3] and shown.station_count == exact.station_count
    assert len(list(Path(root).glob("partials/run=*"))) == 2


def test_a_failed_update_leaves_nothing(spark, tmp_path, stations, rows_of, monkeypatch):
    path, root = f"{tmp_path}/history", f"{tmp_path}/partials"
    write_history(reports(spark, "2024-01-05", 20), path)
    update_partials(spark, root, path)
    before = rows_of(daily_from_partials(spark, root, stations, NOW))
    write_history(reports(spark, "2024-01-05", 20, seed=4), path)
    writer = type(spark.range(1).write)
    save, count = writer.parquet, iter(range(100))

    def second_table_fails(self, *args, **options):
        if next(count) == 1:
            raise OSError("disk full")
        save(self, *args, **options)

    monkeypatch.setattr(writer, "parquet", second_table_fails)
    with pytest.raises(OSError, match="disk full"):
        update_partials(spark, root, path)
    monkeypatch.undo()
    assert rows_of(daily_from_partials(spark, root, stations, NOW)) == before
    assert update_partials(spark, root, path)
    assert rows_of(daily_from_partials(spark, root, stations, NOW)) == expected(rows_of, read_history(spark, path), stations)


def test_profile_from_sketches_alone(spark, tmp_path):
    path, root = f"{tmp_path}/history", f"{tmp_path}/partials"
    start = second("2024-01-05T00:00:00")
    rows = spark.range(20_000).select(
        F.concat(F.lit("s"), F.col("id") % 4_000).alias("station_id"),
        (F.col("id") % 101).cast("int").alias("num_bikes_available"),
        F.lit(3).alias("num_docks_available"),
        (F.col("id") * 4 % 86_400 + start).cast("int").alias("last_reported"),
    )
    write_history(rows, path)
    write_history(rows.withColumn("last_reported", F.col("last_reported") + 86_400), path)
    update_partials(spark, root, path)
    found = profile_from_sketches(spark, root, ranks=[0.1, 0.5, 0.9])
    files = found.inputFiles()
    assert files and all("/sketches/" in f for f in files)
    row = found.first()
    assert (row.row_count, row.first_reported) == (40_000, start)
    assert abs(row.station_count - 4_000) <= 3 * 0.0163 * 4_000
    for rank, bikes, seconds in zip([0.1, 0.5, 0.9], row.bikes, row.seconds):
        assert abs(bikes / 101 - rank) <= 0.03
        assert abs((seconds - start) / 172_800 - rank) <= 0.06
    one = profile_from_sketches(spark, root, days=["2024-01-06"]).first()
    assert (one.row_count, one.first_reported) == (20_000, start + 86_400)
    none = profile_from_sketches(spark, root, days=["1999-01-01"]).first()
    assert (none.row_count, none.first_reported, none.station_count) == (0, None, 0)
    assert partials.daily_from_partials(spark, root, spark.createDataFrame([], "station_id string, station_name string"), NOW, days=["1999-01-01"]).count() == 0
