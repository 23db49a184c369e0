"""Feed documents, topics and decoding of their JSON records."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockmetrics.model import ARRIVED, FEED_ARRAYS, require_columns
from dockmetrics.sources.files import make_folder


@dataclass(frozen=True)
class SourceConf:
    """Where topics come from.

    ``kind`` is ``kafka``, ``files`` (``location/<topic>/`` holds text files, one
    record per line) or ``documents`` (``location/<topic>/`` holds whole feed
    documents, one per file). ``per_trigger`` bounds a micro-batch: records for
    Kafka, files otherwise. ``starting_offsets`` is for Kafka; a folder is always
    read from its first file.

    ``max_file_age`` is how far behind the newest file another may lie and still be
    read. The default drops none, so that backfills can be landed late; its cost is
    the list of all files seen, which a shorter age lets Spark forget.
    """

    kind: str
    location: str
    starting_offsets: str = "latest"
    per_trigger: int | None = None
    max_file_age: str = "36500d"
    options: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ("kafka", "files", "documents"):
            raise ValueError(f"unknown source kind {self.kind!r}")


def explode_feed(documents: DataFrame, feed: str) -> DataFrame:
    """One ``value`` per element of the documents' feed array.

    Elements are kept as JSON text, with nested and undeclared fields. Documents
    that do not parse or have no such array give no rows.
    """
    require_columns(documents, ["value"])
    if feed not in FEED_ARRAYS:
        raise ValueError(f"unknown feed {feed!r}; known: {sorted(FEED_ARRAYS)}")
    array = FEED_ARRAYS[feed]
    envelope = F.from_json(
        F.col("value").cast("string"), f"data struct<{array}: array<string>>"
    )
    return documents.select(
        F.explode(envelope["data"][array]).alias("value"), *_arrival(documents)
    )


def _arrival(df: DataFrame) -> list[str]:
    """The order of arrival, where the source tells it."""
    return [c for c in df.columns if c == ARRIVED]


def _any_field(record: Column, schema: T.StructType) -> Column:
    return reduce(lambda a, b: a | b, (record[f.name].isNotNull() for f in schema.fields))


def decode(messages: DataFrame, schema: T.StructType, *, on_bad: str = "drop") -> DataFrame:
    """Typed columns from JSON in ``value`` (bytes or text).

    Undeclared fields are ignored, missing or wrongly typed ones are null. Text
    that is no such record at all gives only nulls; ``on_bad="drop"`` leaves
    those rows out and ``"keep"`` passes them on.
    """
    require_columns(messages, ["value"])
    record = F.from_json(F.col("value").cast("string"), schema)
    if on_bad == "keep":
        parsed = messages.select(record.alias("record"), *_arrival(messages))
        return parsed.select("record.*", *_arrival(messages))
    if on_bad != "drop":
        raise ValueError(f"on_bad must be 'drop' or 'keep', not {on_bad!r}")
    # A filter after the parse would be pushed below it and parse every record
    # again for its own test; filtering inside the generator parses once.
    usable = F.filter(F.array(record), lambda r: _any_field(r, schema))
    return messages.select(F.inline(usable), *_arrival(messages))


#: Why a message is no record.
NO_TEXT, NOT_JSON, NO_FIELD = "no text", "not JSON", "no usable field"


def parsed_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """(text, record, reason): each message parsed once; ``reason`` is null for records that
    ``decode`` keeps, and tells why the others are none."""
    require_columns(messages, ["value"])
    corrupt = "_corrupt_message"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("text"), F.from_json(text, wide, {"columnNameOfCorruptRecord": corrupt}).alias("parsed")
    )
    found = F.col("parsed")
    reason = (
        F.when(F.col("text").isNull(), NO_TEXT)
        .when(_any_field(found, schema), None)
        .when(found.isNull() | found[corrupt].isNotNull(), NOT_JSON)
        .otherwise(NO_FIELD)
    )
    record = F.struct(*[found[f.name].alias(f.name) for f in schema.fields])
    return parsed.select("text", record.alias("record"), reason.alias("reason"))


def bad_record_counts(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many messages there are and how many hold no usable field."""
    records = decode(messages, schema, on_bad="keep").select(
        F.struct(*schema.fieldNames()).alias("record")
    )
    return records.agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_if(~_any_field(F.col("record"), schema)).alias("bad_count"),
    )


def kafka_options(conf: SourceConf, topic: str) -> dict[str, str]:
    """Reader options of a Kafka subscription."""
    options = {
        "kafka.bootstrap.servers": conf.location,
        "subscribe": topic,
        "startingOffsets": conf.starting_offsets,
        "failOnDataLoss": "false",
    }
    if conf.per_trigger:
        options["maxOffsetsPerTrigger"] = str(conf.per_trigger)
    return {**options, **conf.options}


def kafka_sink_options(conf: SourceConf, topic: str) -> dict[str, str]:
    """Writer options of a Kafka topic; of the other options only the client's
    (``kafka.*``), such as those of a secured broker, concern a writer."""
    client = {k: v for k, v in conf.options.items() if k.startswith("kafka.")}
    return {"kafka.bootstrap.servers": conf.location, "topic": topic, **client}


def ensure_topic(spark: SparkSession, conf: SourceConf, topic: str) -> None:
    """Let a file topic be read before its first record lands. Kafka topics are
    the broker's business."""
    if conf.kind != "kafka":
        make_folder(spark, f"{conf.location}/{topic}")


def read_topic(spark: SparkSession, conf: SourceConf, topic: str) -> DataFrame:
    """The topic as a stream with a ``value`` column, one record per row, and the
    order of arrival: by broker time and offset, or by file."""
    if conf.kind == "kafka":
        stream = spark.readStream.format("kafka").options(**kafka_options(conf, topic)).load()
        return stream.select("value", F.struct("timestamp", "offset").alias(ARRIVED))
    lines = read_landed(spark, conf, topic)
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    messages = lines.select("value", landed.alias(ARRIVED))
    return explode_feed(messages, topic) if conf.kind == "documents" else messages


def read_landed(spark: SparkSession, conf: SourceConf, topic: str) -> DataFrame:
    """The files of a topic's folder as a stream: their lines, or whole documents."""
    reader = spark.readStream.option("maxFileAge", conf.max_file_age).options(**conf.options)
    if conf.per_trigger:
        reader = reader.option("maxFilesPerTrigger", conf.per_trigger)
    return reader.text(f"{conf.location}/{topic}", wholetext=conf.kind == "documents")


def publish(messages: DataFrame, conf: SourceConf, topic: str, checkpoint: str):
    """A stream writer that appends ``value`` to a topic; call ``start()`` on it.

    File topics go through the file sink, whose log makes the append exactly-once.
    """
    writer = messages.select("value").writeStream.option("checkpointLocation", checkpoint)
    if conf.kind == "kafka":
        return writer.format("kafka").options(**kafka_sink_options(conf, topic))
    return writer.format("text").option("path", f"{conf.location}/{topic}")
