"""Command line: ``python -m dockmetrics {ingest,stream,daily,snapshot} ...``"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import UTC, datetime

from dockmetrics.plans import (
    StreamConf,
    keep_running,
    run_daily_job,
    run_ingest_job,
    run_stream_job,
    snapshot,
    wait,
)
from dockmetrics.session import build_session
from dockmetrics.sources import SourceConf, parse_day
from dockmetrics.streaming import ProgressLog


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="dockmetrics")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="landed feed documents to topics")
    ingest.add_argument("--documents", required=True)

    stream = jobs.add_parser("stream", help="the six streaming queries")
    stream.add_argument("--root", required=True)
    stream.add_argument("--history", required=True)
    stream.add_argument("--window", help="tumbling window of the rollups, such as '1 minute'")
    stream.add_argument("--rebalance-history", action="store_true", help="for backfills")
    stream.add_argument("--live-dimension", action="store_true", help="follow the stations by batch")
    stream.add_argument("--fan-out", action="store_true", help="read the bike topic once for its tables")

    for job in (ingest, stream):
        job.add_argument("--source", choices=["kafka", "files", "documents"], default="kafka")
        job.add_argument("--location", required=True, help="bootstrap servers or topic folder")
        job.add_argument("--checkpoints", required=True)
        job.add_argument("--available-now", action="store_true")

    daily = jobs.add_parser("daily", help="per-station figures of one day")
    when = daily.add_mutually_exclusive_group(required=True)
    when.add_argument("day", type=parse_day, nargs="?", help="yyyy-MM-dd")
    when.add_argument("--day-of-month", type=int, choices=range(1, 32), metavar="1..31")
    daily.add_argument("--root", required=True)
    daily.add_argument("--history", required=True)
    daily.add_argument("--skip-unreadable", action="store_true", help="leave damaged files out")

    show = jobs.add_parser("snapshot", help="print the head of every result table")
    show.add_argument("--root", required=True)
    show.add_argument("-n", type=int, default=30)
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "ingest" and args.source == "documents":
        parser.error("ingest writes records: --source must be kafka or files")
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"dockmetrics-{args.job}")
    if args.job == "snapshot":
        for name, frame in snapshot(spark, args.root, n=args.n, labels=True).items():
            print(name)
            frame.show(args.n, truncate=False)
        return 0
    if args.job == "daily":
        run = run_daily_job(
            spark,
            args.day,
            day_of_month=args.day_of_month,
            root=args.root,
            history_path=args.history,
            computed_at=datetime.now(UTC),
            skip_unreadable=args.skip_unreadable,
        )
        return 0 if run.row_count else 1
    spark.streams.addListener(ProgressLog())
    topics = SourceConf(args.source, args.location)
    if args.job == "ingest":
        documents = SourceConf("documents", args.documents)
        queries = run_ingest_job(spark, documents, topics, args.checkpoints, args.available_now)
        wait(queries, bounded=args.available_now)
        return 0
    conf = StreamConf(
        source=topics,
        root=args.root,
        history_path=args.history,
        checkpoints=args.checkpoints,
        window=args.window,
        rebalance_history=args.rebalance_history,
        live_dimension=args.live_dimension,
        fan_out=args.fan_out,
        available_now=args.available_now,
    )
    queries = run_stream_job(spark, conf)
    if conf.available_now:
        wait(queries)
    else:
        keep_running(spark, conf, queries)
    return 0


if __name__ == "__main__":
    sys.exit(main())
