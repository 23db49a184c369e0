"""Keep-last per key: examples and properties."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockmetrics.operators import latest_by_key, top_per_key, with_station_flags

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
readings = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 2),
    ),
    max_size=12,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_by_key_prefers_newest_then_other_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), (None, 5, "n")],
        "k string, v int, payload string",
    )
    expected = [("a", 2, "z"), ("b", None, "q"), (None, 5, "n")]
    assert rows(latest_by_key(df, ["k"], ["v"])) == sorted(expected, key=str)


def test_latest_by_key_keeps_column_order_and_handles_keys_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "v int, k string")
    assert latest_by_key(df, ["k"], ["v"]).columns == ["v", "k"]
    assert rows(latest_by_key(df.select("k"), ["k"], [])) == [("a",)]


@few
@given(readings)
def test_latest_by_key_is_idempotent_and_split_free(spark, data):
    df = spark.createDataFrame(data, "k string, v int, p int")
    once = latest_by_key(df, ["k"], ["v"])
    assert rows(latest_by_key(once, ["k"], ["v"])) == rows(once)
    shuffled = df.orderBy(F.desc("p")).repartition(3)
    assert rows(latest_by_key(shuffled, ["k"], ["v"])) == rows(once)
    best = {}
    for k, v, p in data:
        rank = (-1 if v is None else v, p)
        best[k] = max(best.get(k, (-2, -1)), rank)
    assert rows(once) == sorted(
        ((k, None if v == -1 else v, p) for k, (v, p) in best.items()), key=str
    )


@few
@given(readings)
def test_top_per_key_keeps_at_most_k(spark, data):
    df = spark.createDataFrame(data, "k string, v int, p int")
    kept = top_per_key(df, ["k"], [F.desc("v"), F.desc("p")], 2)
    expected = []
    for key in {k for k, _, _ in data}:
        group = [r for r in data if r[0] == key]
        group.sort(key=lambda r: (-1 if r[1] is None else r[1], r[2]), reverse=True)
        expected += group[:2]
    assert rows(kept) == sorted(expected, key=str)


@few
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 10)), min_size=1, max_size=10))
def test_full_stations_are_nearly_full_too(spark, data):
    df = spark.createDataFrame(data, "num_bikes_available int, capacity int")
    for row in with_station_flags(df).collect():
        assert not row.is_full or row.saturation
        assert row.is_full is None or row.is_full + row.is_empty <= 1
