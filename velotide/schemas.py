"""Schemas of the feeds and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# -- fixed values: field names and formats of the incoming feeds ---------------

# Only the fields that are used are declared, so the JSON reader skips the rest
# (last_updated, ttl, version).
STATUS_PAYLOAD = """
    data struct<stations: array<struct<
        is_installed: int,
        is_renting: int,
        is_returning: int,
        last_reported: bigint,
        num_bikes_available: int,
        num_bikes_available_types: struct<electric: int, smart: int, classic: int>,
        num_docks_available: int,
        station_id: string>>>
"""

STATION_INFO_PAYLOAD = """
    data struct<stations: array<struct<
        station_id: string,
        name: string,
        lon: double,
        lat: double,
        _bcycle_station_type: string,
        address: string>>>
"""

TRIP_CSV = """
    trip_id string,
    duration int,
    start_time timestamp_ntz,
    end_time timestamp_ntz,
    start_station string,
    end_station string,
    bike_id string,
    plan_duration int,
    trip_route_category string,
    passholder_type string,
    bike_type string
"""

# -- tables --------------------------------------------------------------------

RAW_LANDING = "value binary, ingest_ts timestamp, ingest_date date"

STATUS_STAGING = T.StructType(
    [
        T.StructField("utc_timestamp", T.TimestampType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("is_returning", T.BooleanType()),
        T.StructField("is_renting", T.BooleanType()),
        T.StructField("is_installed", T.BooleanType()),
        T.StructField("num_docks_available", T.IntegerType()),
        T.StructField("num_bikes_available", T.IntegerType()),
        T.StructField("num_bikes_available_electric", T.IntegerType()),
        T.StructField("num_bikes_available_smart", T.IntegerType()),
        T.StructField("num_bikes_available_classic", T.IntegerType()),
    ]
)
STATUS_COLUMNS = STATUS_STAGING.fieldNames()

# As stored: in folders by UTC date.
STATUS_TABLE = T.StructType([*STATUS_STAGING, T.StructField("utc_date", T.DateType())])

MEASURES = [
    "num_docks_available",
    "num_bikes_available",
    "num_bikes_available_electric",
    "num_bikes_available_smart",
    "num_bikes_available_classic",
]

STATION_ATTRIBUTES = ["name", "lon", "lat", "station_type", "address"]

DIM_STATIONS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("station_type", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("active_status", T.BooleanType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)

# utc_timestamp is carried beside the wall-clock time: at the autumn clock change
# two instants share one wall-clock time, and only the instant tells them apart.
FACT_STATUS = T.StructType(
    [
        T.StructField("est_datetime", T.TimestampNTZType()),
        T.StructField("station_id", T.StringType()),
        *[T.StructField(name, T.IntegerType()) for name in MEASURES],
        T.StructField("utc_timestamp", T.TimestampType()),
    ]
)

WEATHER_COLUMNS = [
    "date",
    "temperature_2m",
    "relative_humidity_2m",
    "rain",
    "snowfall",
    "cloud_cover",
]
