"""Bikes and docks at the stations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.functions import clock
from velotide.plans.demand import demand_by_hour

HOUR = 3600


def availability_by_hour(fact: DataFrame) -> DataFrame:
    """Mean bikes and docks per local hour of day."""
    return fact.groupBy(F.hour("est_datetime").alias("hour")).agg(
        F.avg("num_bikes_available").alias("avg_bikes"),
        F.avg("num_docks_available").alias("avg_docks"),
    )


def station_fill(fact: DataFrame) -> DataFrame:
    """Mean fill ratio and the shares of empty and full readings per station.

    The ratio is bikes / (bikes + docks), unknown when both are 0.
    """
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    return fact.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg(F.try_divide(bikes, bikes + docks)).alias("fill_ratio"),
        F.avg((bikes == 0).cast("int")).alias("empty_share"),
        F.avg((docks == 0).cast("int")).alias("full_share"),
    )


def latest_status(staging: DataFrame) -> DataFrame:
    """The last reading of each station.

    Readings of one instant are ordered by their other columns.  Every task
    sends one row per station, however often the station reports.
    """
    others = [c for c in staging.columns if c not in ("station_id", "utc_timestamp")]
    last = staging.groupBy("station_id").agg(
        F.max(F.struct("utc_timestamp", *others)).alias("last")
    )
    return last.select("station_id", "last.*").select(*staging.columns)


def demand_vs_availability(trips: DataFrame, fact: DataFrame) -> DataFrame:
    """Trips beside mean bikes and docks, per local hour of day.

    An hour without trips has 0 of them, one without readings unknown means.
    """
    both = demand_by_hour(trips).join(availability_by_hour(fact), "hour", "full_outer")
    return both.withColumn("trips", F.coalesce("trips", F.lit(0)))


# -- weighted by time ----------------------------------------------------------
#
# The mean of readings counts a station that reports every minute ten times as much
# as one that reports every ten.  Here a reading counts for as long as it is the last.


def reading_spans(fact: DataFrame, until: dt.datetime | None = None) -> DataFrame:
    """The readings with ``since`` and ``till``, the epoch seconds between which each is the last known.

    A station's last reading holds until ``until`` (UTC), or has no span if that
    is not given.  Readings within one second, or after ``until``, have none.

    A busy station is cut by UTC date: within one, the next reading is the next
    row; the last of a date takes the first of the station's next date, from a
    table of one row per station and date.
    """
    since = F.unix_seconds("utc_timestamp")
    rows = fact.withColumns({"since": since, "on": F.floor(since / (24 * HOUR))})
    dates = rows.groupBy("station_id", "on").agg(F.min("since").alias("first"))
    by_station = Window.partitionBy("station_id").orderBy("on")
    dates = dates.select("station_id", "on", F.lead("first").over(by_station).alias("next_date"))
    by_date = Window.partitionBy("station_id", "on").orderBy("utc_timestamp")
    rows = rows.withColumn("next", F.lead("since").over(by_date)).join(dates, ["station_id", "on"])
    end = F.coalesce("next", "next_date")
    if until is not None:
        last = F.unix_seconds(F.lit(until.replace(tzinfo=dt.UTC)).cast("timestamp"))
        end = F.least(F.coalesce(end, last), last)
    rows = rows.withColumn("till", end).drop("on", "next", "next_date")
    return rows.where(F.col("till") > F.col("since"))


def weighted_availability_by_hour(
    fact: DataFrame, until: dt.datetime | None = None, zone: str = clock.LOCAL_ZONE
) -> DataFrame:
    """Mean bikes and docks per local hour of day, weighted by time, and the seconds known.

    A span is cut at the full hours, of which each is one local hour; zones whose
    offset is no whole number of hours are not meant.  An unknown count has no weight.
    """
    spans = reading_spans(fact, until)
    start = F.col("since") - F.col("since") % HOUR
    pieces = spans.select(
        "since", "till", "num_bikes_available", "num_docks_available",
        F.explode(F.sequence(start, F.col("till") - 1, F.lit(HOUR).cast("bigint"))).alias("at"),
    )
    seconds = F.least(F.col("till"), F.col("at") + HOUR) - F.greatest("since", "at")
    hour = F.hour(clock.to_local(F.timestamp_seconds("at"), zone))
    pieces = pieces.select(
        hour.alias("hour"), seconds.alias("seconds"),
        F.col("num_bikes_available").alias("bikes"), F.col("num_docks_available").alias("docks"),
    )
    return pieces.groupBy("hour").agg(
        F.sum("seconds").alias("seconds"), _weighted("bikes").alias("avg_bikes"), _weighted("docks").alias("avg_docks")
    )


def weighted_station_fill(fact: DataFrame, until: dt.datetime | None = None) -> DataFrame:
    """Per station the seconds known, mean fill ratio, and shares of time empty and full.

    As ``station_fill``, with time in place of readings.
    """
    spans = reading_spans(fact, until)
    bikes, docks = F.col("num_bikes_available"), F.col("num_docks_available")
    spans = spans.select(
        "station_id", (F.col("till") - F.col("since")).alias("seconds"),
        F.try_divide(bikes, bikes + docks).alias("fill"),
        (bikes == 0).cast("int").alias("empty"), (docks == 0).cast("int").alias("full"),
    )
    return spans.groupBy("station_id").agg(
        F.sum("seconds").alias("seconds"), _weighted("fill").alias("fill_ratio"),
        _weighted("empty").alias("empty_share"), _weighted("full").alias("full_share"),
    )


def _weighted(value: str):
    """The mean of a column over ``seconds``, where it is known; NULL where it never is."""
    known = F.sum(F.when(F.col(value).isNotNull(), F.col("seconds")))
    return F.try_divide(F.sum(F.col(value) * F.col("seconds")), known)
