"""The jobs as commands, one run each, for any scheduler:

    python -m velotide land     --base BASE --servers host:9092 --topic stations_status
    python -m velotide stream   --base BASE --servers host:9092 --topic stations_status
    python -m velotide status   --base BASE --run-date 2024-01-30
    python -m velotide stations --base BASE --run-date 2024-01-30 --documents PATH
    python -m velotide weather  --base BASE --run-date 2024-01-30 --reports PATH
    python -m velotide trips    --base BASE --files GLOB

A failing job exits with an error, so that the scheduler can run it again.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from velotide.plans import warehouse
from velotide.session import build_session
from velotide.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="velotide")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=text)
        added.add_argument("--base", required=True, help="folder of all tables")
        return added

    land = job("land", "store the payloads of the status topic as they come, without end")
    stream = job("stream", "decode the status topic into the staging table, without end")
    for endless in (land, stream):
        endless.add_argument("--servers", required=True)
        endless.add_argument("--topic", required=True)
        endless.add_argument("--min-partitions", help="read few topic partitions in parallel")
        endless.add_argument("--seconds", type=int, default=60, help="time between batches")
        endless.add_argument("--max-offsets", type=int, default=5_000_000, help="messages in a batch")

    compact = job("compact", "merge the batches of closed dates, landed and decoded")
    compact.add_argument("--before", required=True, help="first date that is left as it is")

    status = job("status", "bring the streamed readings into the status fact")
    status.add_argument("--days", type=int, default=1)
    status.add_argument("--backfill", action="store_true", help="first load: all readings there are")
    stations = job("stations", "station documents to staging, snapshot and dimension")
    stations.add_argument("--documents", required=True)
    stations.add_argument("--run-ts", help="default: the run date at 00:00:00")
    weather = job("weather", "append the day's weather reports")
    weather.add_argument("--reports", required=True, help="Parquet files of reports")
    for dated in (status, stations, weather):
        dated.add_argument("--run-date", required=True, help="local date, YYYY-MM-DD")

    trips = job("trips", "rebuild the trip fact")
    trips.add_argument("--files", required=True, help="CSV files, may hold globs")
    trips.add_argument("--timestamp-format")
    trips.add_argument("--keep-rejects", action="store_true", help="put lines that are no trip in a table")
    return parser


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    if args.job in ("land", "stream"):
        options = {"maxOffsetsPerTrigger": str(args.max_offsets)}
        if args.min_partitions:
            options["minPartitions"] = args.min_partitions
        payloads = ingest.read_status_stream(spark, args.servers, args.topic, options)
        sink, name = {
            "land": (ingest.land_raw, warehouse.STATUS_RAW),
            "stream": (ingest.append_status, warehouse.STATUS_STAGING),
        }[args.job]
        checkpoint = f"{args.base}/checkpoints/{name}"
        trigger = {"processingTime": f"{args.seconds} seconds"}
        sink(payloads, f"{args.base}/{name}", checkpoint, trigger).awaitTermination()
    elif args.job == "status":
        warehouse.load_status(spark, args.base, args.run_date, None if args.backfill else args.days)
    elif args.job == "compact":
        before = dt.date.fromisoformat(args.before)
        for name, date in ((warehouse.STATUS_RAW, "ingest_date"), (warehouse.STATUS_STAGING, "utc_date")):
            ingest.compact(spark, f"{args.base}/{name}", date, before)
    elif args.job == "stations":
        run_ts = args.run_ts or f"{args.run_date} 00:00:00"
        warehouse.load_stations(spark, args.documents, args.base, args.run_date, run_ts)
    elif args.job == "weather":
        warehouse.load_weather(spark.read.parquet(args.reports), args.base, args.run_date)
    elif args.job == "trips":
        warehouse.load_trips(
            spark,
            args.files,
            args.base,
            timestamp_format=args.timestamp_format,
            keep_rejects=args.keep_rejects,
        )


if __name__ == "__main__":
    import sys

    run(build_session(), sys.argv[1:])
