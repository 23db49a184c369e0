"""Feed documents, decoding and topic sources."""

import json

import pytest

from dockmetrics.model import (
    FREE_BIKE_STATUS,
    RECORD_SCHEMAS,
    STATION_INFORMATION,
    STATION_STATUS,
    STATION_STATUS_SCHEMA,
)
from dockmetrics.sources import (
    SourceConf,
    bad_record_counts,
    decode,
    explode_feed,
    kafka_options,
    read_topic,
)

GOOD = {"station_id": "a", "num_bikes_available": 1, "num_docks_available": 2, "last_reported": 3}


def messages(spark, *values):
    texts = [(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values]
    return spark.createDataFrame(texts, "value string")


BAD = ["junk", None, "", {}, {"other": 1}, "[1,2]"]
ODD = [
    ({"station_id": "m", "last_reported": 1}, ("m", None, None, 1)),
    ({**GOOD, "num_bikes_available": "7"}, ("a", None, 2, 3)),
    ({**GOOD, "num_bikes_available": True}, ("a", None, 2, 3)),
    ({**GOOD, "extra": {"deep": [1]}}, ("a", 1, 2, 3)),
]


@pytest.mark.parametrize(("record", "expected"), ODD)
def test_decode_nulls_only_the_wrong_field(spark, record, expected):
    for on_bad in ("drop", "keep"):
        out = decode(messages(spark, record), STATION_STATUS_SCHEMA, on_bad=on_bad)
        assert [tuple(r) for r in out.collect()] == [expected]


def test_decode_drops_or_keeps_bad_records(spark):
    mixed = messages(spark, GOOD, *BAD)
    assert [tuple(r) for r in decode(mixed, STATION_STATUS_SCHEMA).collect()] == [("a", 1, 2, 3)]
    kept = decode(mixed, STATION_STATUS_SCHEMA, on_bad="keep")
    assert kept.count() == 1 + len(BAD)
    assert kept.filter("station_id is null").count() == len(BAD)
    assert tuple(bad_record_counts(mixed, STATION_STATUS_SCHEMA).first()) == (7, 6)
    with pytest.raises(ValueError, match="on_bad"):
        decode(mixed, STATION_STATUS_SCHEMA, on_bad="explode")


def test_decode_takes_bytes_and_parses_once(spark):
    out = decode(messages(spark, GOOD).selectExpr("cast(value as binary)"), STATION_STATUS_SCHEMA)
    assert [tuple(r) for r in out.collect()] == [("a", 1, 2, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_explode_feed_keeps_whole_elements(spark):
    nested = {"station_id": "a", "types": [{"count": 1}], "name": "é"}
    docs = messages(
        spark,
        {"data": {"stations": [nested, {"station_id": "b"}]}, "ttl": 60},
        {"data": {}},
        {"data": {"stations": []}},
        "junk",
        None,
    )
    elements = [json.loads(r.value) for r in explode_feed(docs, STATION_STATUS).collect()]
    assert elements == [nested, {"station_id": "b"}]


def test_explode_feed_picks_the_feed_array(spark):
    data = {"bikes": [{"bike_id": "1"}], "stations": [{"station_id": "s"}]}
    docs = messages(spark, {"data": data})
    assert explode_feed(docs, FREE_BIKE_STATUS).first().value == '{"bike_id":"1"}'
    assert explode_feed(docs, STATION_INFORMATION).first().value == '{"station_id":"s"}'
    with pytest.raises(ValueError, match="unknown feed"):
        explode_feed(docs, "weather")


def test_kafka_options():
    conf = SourceConf("kafka", "broker:9092", per_trigger=500, options={"kafka.group.id": "g"})
    assert kafka_options(conf, STATION_STATUS) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "station_status",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500",
        "kafka.group.id": "g",
    }


def test_unknown_source_kind():
    with pytest.raises(ValueError, match="carrier pigeon"):
        SourceConf("carrier pigeon", "loft")


@pytest.mark.parametrize("kind", ["files", "documents"])
def test_read_topic_streams_records(spark, tmp_path, land, kind):
    records = [GOOD, {**GOOD, "station_id": "b"}]
    if kind == "files":
        land(STATION_STATUS, records)
    else:
        text = json.dumps({"data": {"stations": records}}, indent=1)
        land(STATION_STATUS, [text])
    conf = SourceConf(kind, f"{tmp_path}/landing", per_trigger=1)
    stream = decode(read_topic(spark, conf, STATION_STATUS), RECORD_SCHEMAS[STATION_STATUS])
    assert stream.isStreaming
    query = (
        stream.writeStream.format("memory")
        .queryName(f"read_topic_{kind}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = sorted(r.station_id for r in spark.table(f"read_topic_{kind}").collect())
    assert found == ["a", "b"]
