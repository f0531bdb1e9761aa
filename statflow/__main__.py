"""Submit targets: ``stream`` for the snapshot stream, ``state`` for what it holds, ``enrich`` for the batch over JDBC.

spark-submit --packages <kafka connector> -m statflow stream --servers h:9092 --topic t ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from statflow.plans.jobs import enrich_channels
from statflow.session import STREAM_SETTINGS, pin_utc
from statflow.sources.events import broker_options, read_events
from statflow.sources.tables import Database, Split
from statflow.streaming import run
from statflow.streaming.dedup import DELAY, MODES
from statflow.streaming.sinks import AppendSink, DatabaseStore, FolderStore
from statflow.streaming.state import read_state, start_state


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="statflow")
    modes = parser.add_subparsers(dest="job", required=True)

    stream = modes.add_parser("stream", help="messages to snapshots or to the current state")
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topic", required=True)
    stream.add_argument("--group", default="statflow")
    stream.add_argument("--per-trigger", type=int, help="most messages of a trigger; no limit by default")
    stream.add_argument("--checkpoint", required=True, help="on a shared file system")
    stream.add_argument("--dedup", choices=sorted(MODES), default="redelivered")
    stream.add_argument("--delay", default=DELAY)
    stream.add_argument("--trigger", default=run.TRIGGER)
    stream.add_argument("--name", default="channel_snapshots")
    target = stream.add_mutually_exclusive_group(required=True)
    target.add_argument("--state", action="store_true", help="the current state per channel, kept in the checkpoint")
    stream.add_argument("--newer-only", action="store_true", help="event time decides the state, not arrival")
    target.add_argument("--folder", help="folder of appended snapshots")
    target.add_argument("--url", help="database of appended snapshots")
    stream.add_argument("--driver")
    stream.add_argument("--table", default="channel_stats_stream")

    state = modes.add_parser("state", help="the current state of a stream as Parquet")
    state.add_argument("--checkpoint", required=True)
    state.add_argument("--out", required=True)

    enrich = modes.add_parser("enrich", help="one database table to its enriched form")
    enrich.add_argument("--url", required=True)
    enrich.add_argument("--driver", required=True)
    enrich.add_argument("--source", default="channel_stats")
    enrich.add_argument("--target", default="channel_stats_enriched_batch")
    enrich.add_argument("--split", nargs=4, metavar=("COLUMN", "LOWER", "UPPER", "PARTITIONS"))
    return parser.parse_args(argv)


def sink_for(args: argparse.Namespace) -> AppendSink:
    if args.folder:
        return AppendSink(FolderStore(args.folder), args.table, args.name)
    return AppendSink(DatabaseStore(Database(args.url, args.driver)), args.table, args.name)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = pin_utc(SparkSession.builder.appName(f"statflow-{args.job}").getOrCreate())
    if args.job == "enrich":
        split = Split(*args.split[:3], int(args.split[3])) if args.split else None
        enrich_channels(spark, Database(args.url, args.driver), args.source, args.target, split)
        return
    if args.job == "state":
        read_state(spark, args.checkpoint).write.mode("errorifexists").parquet(args.out)
        return
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    options = broker_options(args.servers, args.topic, args.group, args.per_trigger)
    rows = run.snapshots(read_events(spark, options), args.dedup, args.delay)
    if args.state:
        query = start_state(rows, args.checkpoint, args.newer_only, args.name, args.trigger)
    else:
        query = run.start(rows, sink_for(args), args.checkpoint, args.name, args.trigger)
    query.awaitTermination()


if __name__ == "__main__":
    main()
