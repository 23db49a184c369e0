"""Stream sinks: keyed result tables, the partitioned history, late and rejected records."""

from dockmetrics.streaming.fanout import adding, fan_out_sink, replacing
from dockmetrics.streaming.live import enrich_sink, read_enriched, read_late_reports
from dockmetrics.streaming.progress import ProgressLog, counted
from dockmetrics.streaming.quarantine import quarantine_sink
from dockmetrics.streaming.sinks import history_sink, replace_sink, upsert_sink

__all__ = [
    "ProgressLog",
    "adding",
    "counted",
    "enrich_sink",
    "fan_out_sink",
    "history_sink",
    "quarantine_sink",
    "read_enriched",
    "read_late_reports",
    "replace_sink",
    "replacing",
    "upsert_sink",
]
