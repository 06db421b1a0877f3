"""The daily jobs: feeds into staging, staging into the star schema.

All tables lie below one base path.  The last run of every job may be run again.  A
station job of an earlier day is put into the dimension at its place, as long as the
snapshots since are kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from velotide.functions.clock import UTC_PAD_DAYS, as_date, window
from velotide.functions.keys import SUFFIX_LENGTH
from velotide.operators import history, scd
from velotide.operators.dedup import assert_unique
from velotide.operators.merge import load_status_increment, read_status_fact
from velotide.operators.trips import trip_fact
from velotide.session import sized_shuffles
from velotide.sources import files, snapshots, tables, versions
from velotide.sources.feeds import (
    assert_complete,
    good_trips,
    read_station_documents,
    read_trip_lines,
    read_trips,
    station_entries,
    station_rows,
    trip_rejects,
    weather_rows,
)
from velotide.streaming.ingest import read_status_table

TRIPS = "fct_trip_data"
TRIP_LINES, TRIP_REJECTS = "stg_trip_lines", "trip_rejects"
STATIONS = "dim_stations_scd"
STATUS_FACT = "fct_stations_status"
STATUS_RAW = "raw_stations_status"
STATUS_STAGING = tables.table_name("stations_status")


def load_stations(
    spark: SparkSession,
    documents: str,
    base: str,
    run_date: dt.date | str,
    run_ts: str,
    whole_files: bool = True,
    key_length: int = SUFFIX_LENGTH,
) -> None:
    """Station documents into staging, the dimension and the dated snapshot.

    A station's key is the last ``key_length`` characters of its id; where the ids
    differ before those only, it has to be longer, or the job fails.

    Documents and keys are checked before anything is written.  The snapshot,
    which is written once, comes last: a day that failed can be run again.  A
    run older than the last one stores its snapshot first, and the dimension is
    derived again from the snapshots for the stations that it changes.
    """
    texts = read_station_documents(spark, documents, whole_files)
    with sized_shuffles(spark, documents):
        assert_complete(texts)
        rows = station_rows(station_entries(texts), key_length)
        assert_unique(rows, ["station_id"])
        tables.load_table(rows, base, "stations_info", tables.TRUNCATE)
        staged = tables.read_table(spark, base, "stations_info")
        dimension, kept = f"{base}/{STATIONS}", f"{base}/snapshots"
        if scd.is_late(spark, dimension, run_ts):
            snapshots.snapshot_csv(staged, kept, run_date)
            history.put_in_late(spark, dimension, kept, run_date, run_ts)
        else:
            scd.apply_snapshot(staged, dimension, run_date, run_ts)
            snapshots.snapshot_csv(staged, kept, run_date)


def load_weather(reports: DataFrame, base: str, run_date: dt.date | str) -> None:
    """Append the day's weather reports to staging."""
    load_id = as_date(run_date).isoformat()
    tables.load_table(weather_rows(reports), base, "weather", tables.APPEND, load_id=load_id)


def load_trips(
    spark: SparkSession,
    path: str,
    base: str,
    timestamp_format: str | None = None,
    keep_rejects: bool = False,
) -> None:
    """Rebuild the trip fact from all quarterly files.

    A line that is no trip fails the job, or with ``keep_rejects`` goes to the
    table of rejects (``read_trip_rejects``), which is rebuilt, too.
    """
    with sized_shuffles(spark, path):
        if not keep_rejects:
            trips = read_trips(spark, path, timestamp_format=timestamp_format)
        else:
            lines = tables.rebuild(read_trip_lines(spark, path, timestamp_format), f"{base}/{TRIP_LINES}")
            tables.rebuild(trip_rejects(lines), f"{base}/{TRIP_REJECTS}")
            trips = good_trips(lines)
        tables.rebuild(trip_fact(trips), f"{base}/{TRIPS}")


def read_trip_rejects(spark: SparkSession, base: str) -> DataFrame:
    """(file, line) of the last load that kept them."""
    return versions.read(spark, f"{base}/{TRIP_REJECTS}")


def load_status(
    spark: SparkSession, base: str, run_date: dt.date | str, days: int | None = 1
) -> None:
    """Bring the streamed readings of the window into the status fact.

    ``days=None`` is the first load: all readings there are, whatever their date.
    """
    dates = None if days is None else window(run_date, days, UTC_PAD_DAYS)
    path = f"{base}/{STATUS_STAGING}"
    staging = read_status_table(spark, path, dates)
    # A window's folders are a part of the table; their names give its dates.
    folders = [path] if dates is None else files.day_folders(spark, path, "utc_date", *dates)
    with sized_shuffles(spark, *folders):
        load_status_increment(staging, f"{base}/{STATUS_FACT}", run_date, days)


def read_trip_fact(spark: SparkSession, base: str) -> DataFrame:
    return versions.read(spark, f"{base}/{TRIPS}")


def read_weather(spark: SparkSession, base: str) -> DataFrame:
    """All loads of the weather, with their ``load_id``."""
    return tables.read_table(spark, base, "weather")


def read_dimension(spark: SparkSession, base: str) -> DataFrame:
    return scd.read_stations(spark, f"{base}/{STATIONS}")


def read_status(spark: SparkSession, base: str) -> DataFrame:
    return read_status_fact(spark, f"{base}/{STATUS_FACT}")
