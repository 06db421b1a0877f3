"""Trip fact and its lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions import values
from velotide.operators.sizing import BROADCAST_BYTES, broadcast_if_small


def trip_fact(staging: DataFrame) -> DataFrame:
    """Staged trips as facts.  A trip_id that is no whole number fails the query."""
    return staging.select(
        F.col("trip_id").cast("bigint").alias("trip_id"),
        "duration",
        "start_time",
        "end_time",
        "start_station",
        "end_station",
        "bike_id",
        "plan_duration",
        values.is_round_trip(F.col("trip_route_category")).alias("is_round_trip"),
        "passholder_type",
        values.bike_kind(F.col("bike_type")).alias("bike_type"),
    )


def trips_with_stations(
    trips: DataFrame,
    stations: DataFrame,
    columns: tuple[str, ...] = ("name",),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Trips with ``start_<column>`` and ``end_<column>`` of their two stations.

    ``stations`` holds one row per ``station_id``.  It plays both roles; it is
    measured once, and when small one broadcast serves both joins.  Trips whose
    station is unknown keep NULLs.
    """
    side = broadcast_if_small(stations.select("station_id", *columns), broadcast_bytes)
    s, e = side.alias("s"), side.alias("e")
    return (
        trips.alias("t")
        .join(s, F.col("t.start_station") == F.col("s.station_id"), "left")
        .join(e, F.col("t.end_station") == F.col("e.station_id"), "left")
        .select(
            "t.*",
            *[F.col(f"s.{c}").alias(f"start_{c}") for c in columns],
            *[F.col(f"e.{c}").alias(f"end_{c}") for c in columns],
        )
    )
