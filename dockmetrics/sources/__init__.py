"""Feeds, the raw history and the result tables."""

from dockmetrics.sources.feeds import (
    SourceConf,
    bad_record_counts,
    decode,
    ensure_topic,
    explode_feed,
    kafka_options,
    kafka_sink_options,
    publish,
    read_landed,
    read_topic,
)
from dockmetrics.sources.history import (
    history_rows,
    parse_day,
    read_day_of_month_history,
    read_history,
    union_history,
    unreadable_files,
    write_history,
)
from dockmetrics.sources.tables import compact, ensure_tables, next_run, read_table, upsert

__all__ = [
    "SourceConf",
    "bad_record_counts",
    "compact",
    "decode",
    "ensure_tables",
    "ensure_topic",
    "explode_feed",
    "history_rows",
    "kafka_options",
    "kafka_sink_options",
    "next_run",
    "parse_day",
    "publish",
    "read_day_of_month_history",
    "read_history",
    "read_landed",
    "read_table",
    "read_topic",
    "union_history",
    "unreadable_files",
    "upsert",
    "write_history",
]
