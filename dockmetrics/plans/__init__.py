"""Whole jobs: speed layer, daily figures, serving snapshot."""

from dockmetrics.plans.daily import DailyRun, preview, run_daily_job
from dockmetrics.plans.serving import register_views, snapshot
from dockmetrics.plans.speed import (
    StreamConf,
    keep_running,
    run_ingest_job,
    run_stream_job,
    wait,
)

__all__ = [
    "DailyRun",
    "StreamConf",
    "keep_running",
    "preview",
    "register_views",
    "run_daily_job",
    "run_ingest_job",
    "run_stream_job",
    "snapshot",
    "wait",
]
