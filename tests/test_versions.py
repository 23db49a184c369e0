"""Tables with numbered snapshots: merges, pinned readers, two writers, untouched files."""

import random
import threading
from pathlib import Path

import pytest

from dockmetrics.model import STATION_STATUS_SCHEMA, TableSpec
from dockmetrics.sources import files, versions
from dockmetrics.sources.versions import current_version, live_files, merge, read_version, vacuum

SPEC = TableSpec(
    name="latest",
    schema=STATION_STATUS_SCHEMA,
    keys=("station_id",),
    order=(("station_id", False),),
    version=("last_reported",),
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema).repartition(3)


def shown(df):
    return {r.station_id: (r.num_bikes_available, r.last_reported) for r in df.collect()}


def test_merges_equal_a_dictionary(spark, tmp_path):
    root, rng, expected = str(tmp_path), random.Random(3), {}
    assert read_version(spark, root, SPEC).count() == 0
    for _ in range(5):
        rows = [(f"s{rng.randrange(60):02d}", rng.randrange(9), 0, rng.randrange(1000)) for _ in range(25)]
        merge(frame(spark, [*rows, (None, 1, 1, 1)]), root, SPEC, rows_per_file=8)
        best = {}
        for station, bikes, _, at in rows:
            best[station] = max(best.get(station, (-1, -1)), (at, bikes))
        expected |= {s: (bikes, at) for s, (at, bikes) in best.items()}
        assert shown(read_version(spark, root, SPEC)) == expected
    assert merge(frame(spark, []), root, SPEC) == current_version(spark, root, SPEC) == 5


def test_untouched_files_stay_and_old_versions_can_be_read(spark, tmp_path):
    root = str(tmp_path)
    merge(frame(spark, [(f"s{i:03d}", i, 0, i) for i in range(100)]), root, SPEC, rows_per_file=10)
    before = {f.path for f in live_files(spark, root, SPEC, 1)}
    assert len(before) >= 8
    times = {p: (Path(root) / SPEC.name / p).stat().st_mtime_ns for p in before}
    pinned = read_version(spark, root, SPEC)
    merge(frame(spark, [("s042", 7, 0, 900), ("s043", 8, 0, 900)]), root, SPEC, rows_per_file=10)
    after = {f.path for f in live_files(spark, root, SPEC, 2)}
    assert len(before - after) <= 2
    assert all((Path(root) / SPEC.name / p).stat().st_mtime_ns == times[p] for p in before & after)
    assert shown(pinned)["s042"] == shown(read_version(spark, root, SPEC, 1))["s042"] == (42, 42)
    now = shown(read_version(spark, root, SPEC))
    assert now["s042"] == (7, 900) and len(now) == 100
    # the ranges of live files do not overlap
    ranges = sorted((f.low, f.high) for f in live_files(spark, root, SPEC, 2))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_two_writers_lose_no_rows(spark, tmp_path):
    root, failures = str(tmp_path), []

    def write(name):
        try:
            for i in range(3):
                merge(frame(spark, [(f"{name}{i}", i, 0, i), ("both", i, 0, i)]), root, SPEC)
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    writers = [threading.Thread(target=write, args=(name,)) for name in "ab"]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert not failures
    assert set(shown(read_version(spark, root, SPEC))) == {f"{n}{i}" for n in "ab" for i in range(3)} | {"both"}
    assert current_version(spark, root, SPEC) == 6


def test_a_writer_that_comes_second_merges_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    merge(frame(spark, [("a", 1, 0, 1)]), root, SPEC)
    commit, first = versions._commit, iter([True])

    def overtaken(session, *args):
        if next(first, False):
            merge(frame(spark, [("b", 2, 0, 2)]), root, SPEC)
        return commit(session, *args)

    monkeypatch.setattr(versions, "_commit", overtaken)
    assert merge(frame(spark, [("a", 3, 0, 3), ("c", 3, 0, 3)]), root, SPEC) == 3
    assert shown(read_version(spark, root, SPEC)) == {"a": (3, 3), "b": (2, 2), "c": (3, 3)}
    used = {f.path.split("/")[1] for v in (1, 2, 3) for f in live_files(spark, root, SPEC, v)}
    assert set(files.children(spark, f"{root}/{SPEC.name}/data")) == used


def test_reads_list_no_data_folders(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    merge(frame(spark, [("a", 1, 0, 1)]), root, SPEC)
    listed = []
    monkeypatch.setattr(versions, "children", lambda s, p: listed.append(p) or files.children(s, p))
    assert read_version(spark, root, SPEC).count() == 1
    assert [p.rsplit("/", 1)[1] for p in listed] == ["_versions"]


def test_vacuum_keeps_what_the_newest_versions_use(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        merge(frame(spark, [("a", i, 0, i), (f"z{i}", i, 0, i)]), root, SPEC, rows_per_file=1)
    vacuum(spark, root, SPEC, keep_versions=2)
    assert shown(read_version(spark, root, SPEC))["a"] == (3, 3)
    assert shown(read_version(spark, root, SPEC, 3))["a"] == (2, 2)
    with pytest.raises(Exception, match="exist"):
        read_version(spark, root, SPEC, 1)
    merge(frame(spark, [("b", 1, 0, 1)]), root, SPEC)
    assert len(shown(read_version(spark, root, SPEC))) == 6
