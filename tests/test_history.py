"""The partitioned raw history."""

from datetime import UTC, date, datetime
from pathlib import Path

import pytest

from dockmetrics.model import HISTORY_SCHEMA
from dockmetrics.sources import (
    files,
    history_log,
    history_rows,
    read_day_of_month_history,
    read_history,
    union_history,
    unreadable_files,
    write_history,
)
from dockmetrics.sources.history_log import commit_batch

STATUS = "station_id string, num_bikes_available int, num_docks_available int, last_reported int"


def second(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp())


MOMENTS = [
    "2024-01-05T03:00:00",
    "2024-01-05T23:59:59",
    "2024-01-27T03:30:00",
    "2024-02-05T03:00:00",
    "2023-01-05T00:00:00",
]


@pytest.fixture
def history(spark, tmp_path):
    rows = [(f"s{i}", i, 10 - i, second(m)) for i, m in enumerate(MOMENTS)]
    write_history(spark.createDataFrame(rows, STATUS), f"{tmp_path}/history")
    return f"{tmp_path}/history"


def ids(df):
    return sorted(r.station_id for r in df.collect())


def test_reads_exactly_one_date(spark, history):
    assert ids(read_history(spark, history, "2024-01-05")) == ["s0", "s1"]
    assert ids(read_history(spark, history, date(2024, 2, 5))) == ["s3"]
    assert ids(read_history(spark, history, "2024-01-06")) == []
    assert ids(read_history(spark, history)) == ["s0", "s1", "s2", "s3", "s4"]


def test_day_of_month_mixes_months_and_years(spark, history):
    assert ids(read_history(spark, history, day_of_month=5)) == ["s0", "s1", "s3", "s4"]
    for wrong in (0, 32, 40):
        with pytest.raises(ValueError, match="1 to 31"):
            read_history(spark, history, day_of_month=wrong)


def test_partition_keys_and_values(spark, history):
    row = read_history(spark, history, "2024-01-27").first()
    assert (row.hour, row.num_bikes_available, row.last_reported) == (3, 2, second(MOMENTS[2]))
    folders = {str(p.relative_to(history)) for p in Path(history).glob("day=*/hour=*")}
    assert "day=2024-01-05/hour=3" in folders and "day=2024-01-05/hour=23" in folders
    assert read_history(spark, history).schema == HISTORY_SCHEMA


def test_date_filter_prunes_folders(spark, history):
    plan = read_history(spark, history, "2024-01-05")._jdf.queryExecution().executedPlan()
    assert "(day#" in plan.toString().split("PartitionFilters:")[1].split("]")[0]


@pytest.mark.parametrize("wrong", ["abc", "40", "2024-13-01", ""])
def test_invalid_dates_are_refused(spark, history, wrong):
    with pytest.raises(ValueError):
        read_history(spark, history, wrong)


def test_missing_folder_reads_as_empty(spark, tmp_path):
    empty = read_history(spark, f"{tmp_path}/nowhere", "2024-01-05")
    assert empty.schema == HISTORY_SCHEMA and empty.count() == 0


def test_unreadable_files_are_skipped_or_reported(spark, history):
    folder = next(Path(history).glob("day=2024-01-27/hour=3"))
    (folder / "part-bad.parquet").write_bytes(b"not parquet at all")
    assert len(ids(read_history(spark, history, skip_unreadable=True))) == 5
    with pytest.raises(Exception, match="part-bad"):
        read_history(spark, history).collect()
    bad = unreadable_files(spark, history, "2024-01-27")
    assert [f.rsplit("/", 1)[1] for f in bad] == ["part-bad.parquet"]
    assert unreadable_files(spark, history, "2024-01-05") == []
    assert unreadable_files(spark, history, day_of_month=27) == bad
    # a day of which nothing can be read is an empty day
    only = Path(history) / "day=2023-07-01/hour=1"
    only.mkdir(parents=True)
    (only / "part-cut.parquet").write_bytes(next(Path(history).glob("day=2024-01-05/*/*.parquet")).read_bytes()[:-20])
    assert read_history(spark, history, "2023-07-01", skip_unreadable=True).count() == 0


def test_a_file_broken_in_the_middle_is_left_out_whole(spark, history):
    folder = next(Path(history).glob("day=2024-01-27/hour=3"))
    rows = [(f"m{i}", i, i, second("2024-01-27T03:00:00")) for i in range(3000)]
    spark.createDataFrame(rows, STATUS).coalesce(1).selectExpr(
        "*", "timestamp_seconds(last_reported) as timestamp"
    ).write.option("parquet.page.size", 512).option("parquet.page.row.count.limit", 100).mode("append").parquet(str(folder))
    broken = max(folder.glob("*.parquet"), key=lambda p: p.stat().st_size)
    assert unreadable_files(spark, history) == []
    content = bytearray(broken.read_bytes())
    content[len(content) // 2 : len(content) // 2 + 40] = bytes(40)
    broken.write_bytes(bytes(content))
    for checksum in folder.glob(".*.crc"):
        checksum.unlink()
    assert [f.rsplit("/", 1)[1] for f in unreadable_files(spark, history, "2024-01-27")] == [broken.name]
    assert ids(read_history(spark, history, "2024-01-27", skip_unreadable=True)) == ["s2"]


def test_only_the_files_of_a_day_are_listed(spark, history):
    one = Path(history).glob("day=2024-01-05/*/*.parquet")
    listed = read_history(spark, history, "2024-01-05").inputFiles()
    assert sorted(f.rsplit("/", 1)[1] for f in listed) == sorted(p.name for p in one)
    month_days = read_history(spark, history, day_of_month=5).inputFiles()
    assert len(month_days) == len(list(Path(history).glob("day=*-05/*/*.parquet")))
    assert read_history(spark, history, "1999-01-01").count() == 0
    assert read_history(spark, history, "2024-01-05").schema == HISTORY_SCHEMA


def test_missing_day_of_month_layout_reads_as_empty(spark, tmp_path):
    assert read_day_of_month_history(spark, f"{tmp_path}/nowhere").count() == 0


def test_day_of_month_layout_is_read_by_full_date(spark, tmp_path, history, rows_of):
    old = f"{tmp_path}/old"
    rows = read_history(spark, history)
    by_month_day = rows.selectExpr(
        "* except (day, hour)", "date_format(day, 'dd') as day", "lpad(hour, 2, '0') as hour"
    )
    by_month_day.write.partitionBy("day", "hour").parquet(old)
    assert (Path(old) / "day=05" / "hour=03").exists()
    assert rows_of(read_day_of_month_history(spark, old)) == rows_of(rows)
    one = read_day_of_month_history(spark, old, "2024-01-05")
    assert ids(one) == ["s0", "s1"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "= 5)" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert union_history([rows, read_day_of_month_history(spark, old)]).count() == 10


def test_union_is_by_name_and_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "station_id string, n int")
    b = spark.createDataFrame([(2, "y")], "n int, station_id string")
    c = spark.createDataFrame([("z",)], "station_id string")
    rows = sorted(tuple(r) for r in union_history([a, b]).collect())
    assert rows == [("x", 1), ("y", 2)]
    assert sorted((r.station_id, r.n) for r in union_history([a, c]).collect()) == [
        ("x", 1),
        ("z", None),
    ]
    assert union_history([a, a]).count() == 2
    with pytest.raises(ValueError, match="nothing"):
        union_history([])


# --- histories that streams commit to ---------------------------------------------


def status_rows(spark, *moments, station="s"):
    rows = [(f"{station}{i}", i, 10 - i, second(m)) for i, m in enumerate(moments)]
    return history_rows(spark.createDataFrame(rows, STATUS))


def test_a_daily_read_lists_only_that_days_entries_and_files(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/history"
    for batch in range(4):
        rows = status_rows(spark, f"2024-01-0{batch + 1}T03:00:00", "2024-01-09T05:00:00")
        commit_batch(rows, path, 1, batch)
    listed, read = [], []
    monkeypatch.setattr(history_log, "children", lambda s, p: listed.append(p) or files.children(s, p))
    monkeypatch.setattr(history_log, "read_bytes", lambda s, p: read.append(p) or files.read_bytes(s, p))
    day = read_history(spark, path, "2024-01-02")
    assert ids(day) == ["s0"]
    assert len(day.inputFiles()) == 1
    assert {p.rsplit("/", 1)[1] for p in listed} == {"day=2024-01-02"}
    assert len(read) == 1
    assert ids(read_history(spark, path, "2024-01-09")) == ["s1"] * 4
    assert read_history(spark, path).count() == 8
    assert ids(read_history(spark, path, day_of_month=3)) == ["s0"]
    assert read_history(spark, path, "2024-01-02").schema == HISTORY_SCHEMA


def test_a_committed_batch_is_not_written_again_and_a_failed_one_is(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/history"
    rows = status_rows(spark, "2024-01-01T03:00:00", "2024-01-02T03:00:00")
    commit_batch(rows, path, 1, 0)
    commit_batch(rows, path, 1, 0)
    assert read_history(spark, path).count() == 2

    def fails_on_the_second_day(session, target, content):
        if "day=2024-01-02" in target:
            raise OSError("lost")
        files.write_bytes(session, target, content)

    monkeypatch.setattr(history_log, "write_bytes", fails_on_the_second_day)
    with pytest.raises(OSError, match="lost"):
        commit_batch(rows, path, 1, 1)
    monkeypatch.undo()
    assert read_history(spark, path, "2024-01-02").count() == 1
    commit_batch(rows, path, 1, 1)
    assert read_history(spark, path).count() == 4
    assert len(list(Path(path).glob("_log/data/run=1/batch_id=1/attempt=*"))) == 1


def test_entries_of_a_day_are_folded_and_old_ones_go(spark, tmp_path):
    path = f"{tmp_path}/history"
    for batch in range(8):
        commit_batch(status_rows(spark, "2024-01-01T03:00:00"), path, 1, batch, fold_every=3)
        assert read_history(spark, path, "2024-01-01").count() == batch + 1
    entries = files.children(spark, f"{path}/_log/days/day=2024-01-01")
    assert [e for e in entries if not e.startswith(".")] == [
        "commit-1-3", "commit-1-4", "commit-1-5", "commit-1-6", "commit-1-7", "upto-1-2", "upto-1-5",
    ]
    assert history_log.next_history_run(spark, path) == 2
    commit_batch(status_rows(spark, "2024-01-01T04:00:00"), path, 2, 0, fold_every=3)
    assert read_history(spark, path, "2024-01-01").count() == 9


def test_batches_and_streams_share_a_history(spark, tmp_path):
    path = f"{tmp_path}/history"
    commit_batch(status_rows(spark, "2024-01-01T03:00:00"), path, 1, 0)
    backfill = status_rows(spark, "2024-01-01T04:00:00", "2023-12-31T01:00:00", station="old")
    write_history(backfill.select("station_id", "num_bikes_available", "num_docks_available", "last_reported"), path)
    assert ids(read_history(spark, path, "2024-01-01")) == ["old0", "s0"]
    assert ids(read_history(spark, path)) == ["old0", "old1", "s0"]
    assert unreadable_files(spark, path) == []
    committed = next(Path(path).glob("_log/data/**/*.parquet"))
    committed.write_bytes(committed.read_bytes()[:-9])
    for checksum in committed.parent.glob(".*.crc"):
        checksum.unlink()
    assert ids(read_history(spark, path, skip_unreadable=True)) == ["old0", "old1"]


def test_rows_without_a_time_are_kept(spark, tmp_path):
    path = f"{tmp_path}/history"
    commit_batch(history_rows(spark.createDataFrame([("s", 1, 2, None)], STATUS)), path, 1, 0)
    assert [(r.station_id, r.day, r.hour) for r in read_history(spark, path).collect()] == [("s", None, None)]
    assert read_history(spark, path, "2024-01-01").count() == 0


def test_a_committed_batch_without_rows(spark, tmp_path):
    path = f"{tmp_path}/history"
    commit_batch(history_rows(spark.createDataFrame([], STATUS)), path, 1, 0)
    assert read_history(spark, path).count() == 0
