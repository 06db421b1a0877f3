"""The test tables in the shape of the feeds.

``events`` stands in for the station status (user -> station, value -> bikes)
and for trip starts, ``orders`` and ``lineitem`` for trips, ``supplier`` for
stations.  Each stand-in is a projection: it adds no shuffle, and its size
follows the table.  The SQL fragments say the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.operators.merge import status_fact_rows

# -- status --------------------------------------------------------------------


def status_staging(events: DataFrame) -> DataFrame:
    bikes = F.col("value").cast("int")
    electric = F.floor(bikes / 3).cast("int")
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("ts").cast("timestamp").alias("utc_timestamp"),
        F.col("user_id").cast("string").alias("station_id"),
        (~failed).alias("is_returning"),
        (F.col("event_type") != "view").alias("is_renting"),
        F.lit(True).alias("is_installed"),
        F.when(failed, 0).otherwise(F.greatest(F.lit(0), 50 - bikes)).alias("num_docks_available"),
        bikes.alias("num_bikes_available"),
        electric.alias("num_bikes_available_electric"),
        F.when(F.col("event_type") != "click", 0).alias("num_bikes_available_smart"),
        (bikes - electric).alias("num_bikes_available_classic"),
    )


STATUS_SQL = """
    status AS (
        SELECT ts AS utc_timestamp,
               CAST(user_id AS VARCHAR) AS station_id,
               event_type <> 'error' AS is_returning,
               event_type <> 'view' AS is_renting,
               TRUE AS is_installed,
               CASE WHEN event_type = 'error' THEN 0
                    ELSE greatest(0, 50 - CAST(trunc(value) AS INTEGER)) END AS num_docks_available,
               CAST(trunc(value) AS INTEGER) AS num_bikes_available,
               CAST(trunc(value) AS INTEGER) // 3 AS num_bikes_available_electric,
               CASE WHEN event_type <> 'click' THEN 0 END AS num_bikes_available_smart,
               CAST(trunc(value) AS INTEGER) - CAST(trunc(value) AS INTEGER) // 3
                   AS num_bikes_available_classic
        FROM events)"""


def status_repeated(events: DataFrame) -> DataFrame:
    """Every reading three times: as sent, corrected by one bike, and repeated."""
    copies = status_staging(events).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(0))))
    return copies.withColumn(
        "num_bikes_available", F.col("num_bikes_available") + F.col("copy")
    ).drop("copy")


STATUS_REPEATED_SQL = f"""
    {STATUS_SQL.strip()},
    repeated AS (
        SELECT * FROM status
        UNION ALL SELECT * FROM status
        UNION ALL SELECT * REPLACE (num_bikes_available + 1 AS num_bikes_available) FROM status)"""

LOCAL = "timezone('America/New_York', timezone('UTC', {0}))"


def status_fact(events: DataFrame) -> DataFrame:
    return status_fact_rows(status_staging(events))


STATUS_FACT_SQL = f"""
    {STATUS_SQL.strip()},
    fact AS (
        SELECT {LOCAL.format('utc_timestamp')} AS est_datetime, station_id,
               num_docks_available, num_bikes_available, num_bikes_available_electric,
               num_bikes_available_smart, num_bikes_available_classic, utc_timestamp
        FROM status)"""


def status_payloads(events: DataFrame) -> DataFrame:
    """One JSON payload per event, with the event's id and its time of arrival.

    A payload lists the station and a kiosk, whose id has no digits and whose
    counts are missing.  The payloads of one event type arrive cut off.
    """
    bikes = F.col("value").cast("int")
    electric = F.floor(bikes / 3).cast("int")
    flags = [
        F.lit(1).alias("is_installed"),
        (F.col("event_type") != "view").cast("int").alias("is_renting"),
        (F.col("event_type") != "error").cast("int").alias("is_returning"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_reported"),
    ]
    types = F.struct(electric.alias("electric"), (bikes - electric).alias("classic"))
    station = F.struct(
        *flags,
        bikes.alias("num_bikes_available"),
        types.alias("num_bikes_available_types"),
        F.greatest(F.lit(0), 50 - bikes).alias("num_docks_available"),
        F.concat(F.lit("hub_"), F.col("user_id").cast("string")).alias("station_id"),
    )
    kiosk = F.struct(
        *flags,
        F.lit(None).cast("int").alias("num_bikes_available"),
        F.lit(None).cast("struct<electric:int,classic:int>").alias("num_bikes_available_types"),
        F.lit(None).cast("int").alias("num_docks_available"),
        F.lit("kiosk").alias("station_id"),
    )
    payload = F.to_json(
        F.struct(
            F.struct(F.array(station, kiosk).alias("stations")).alias("data"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_updated"),
            F.lit(60).alias("ttl"),
            F.lit("1.1").alias("version"),
        )
    )
    received = F.when(
        F.col("event_type") == "signup", F.substring(payload, F.lit(1), F.length(payload) - 40)
    ).otherwise(payload)
    return events.select(
        F.encode(received, "UTF-8").alias("value"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )


DECODED_SQL = """
    whole AS (
        SELECT date_trunc('second', ts) AS utc_timestamp, user_id, event_type,
               CAST(trunc(value) AS INTEGER) AS bikes
        FROM events WHERE event_type <> 'signup'),
    decoded AS (
        SELECT utc_timestamp, CAST(user_id AS VARCHAR) AS station_id,
               event_type <> 'error' AS is_returning, event_type <> 'view' AS is_renting,
               TRUE AS is_installed, greatest(0, 50 - bikes) AS num_docks_available,
               bikes AS num_bikes_available, bikes // 3 AS num_bikes_available_electric,
               CAST(NULL AS INTEGER) AS num_bikes_available_smart,
               bikes - bikes // 3 AS num_bikes_available_classic
        FROM whole
        UNION ALL
        SELECT utc_timestamp, '', event_type <> 'error', event_type <> 'view',
               TRUE, NULL, NULL, NULL, NULL, NULL
        FROM whole)"""

# -- trips ---------------------------------------------------------------------


def trip_starts(events: DataFrame) -> DataFrame:
    """Trips with a start time only, which is local time."""
    return events.select(F.col("ts").alias("start_time"))


def trip_staging(orders: DataFrame) -> DataFrame:
    """``orders`` as the trip feed, every column of it filled."""
    minutes = F.floor(F.col("o_totalprice") / 10000).cast("int")
    kind = F.col("o_orderpriority")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        minutes.alias("duration"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=minutes)).alias("end_time"),
        F.col("o_custkey").cast("string").alias("start_station"),
        (F.col("o_custkey") + 1).cast("string").alias("end_station"),
        F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("bike_id"),
        F.when(status == "P", 30).otherwise(365).alias("plan_duration"),
        F.when(status == "F", "Round Trip").when(status == "O", "One Way").alias("trip_route_category"),
        F.when(status == "P", "Month").otherwise("Year").alias("passholder_type"),
        F.when(kind == "1-URGENT", "standard")
        .when(kind == "2-HIGH", "Standard")
        .when(kind == "3-MEDIUM", "electric")
        .when(kind == "4-NOT SPECIFIED", "classic")
        .alias("bike_type"),
    )


TRIP_STAGING_SQL = """
    staging AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id,
               CAST(floor(o_totalprice / 10000) AS INTEGER) AS duration,
               o_orderdate AS start_time,
               o_orderdate + to_minutes(CAST(floor(o_totalprice / 10000) AS INTEGER)) AS end_time,
               CAST(o_custkey AS VARCHAR) AS start_station,
               CAST(o_custkey + 1 AS VARCHAR) AS end_station,
               'b' || CAST(o_custkey AS VARCHAR) AS bike_id,
               CASE WHEN o_orderstatus = 'P' THEN 30 ELSE 365 END AS plan_duration,
               CASE o_orderstatus WHEN 'F' THEN 'Round Trip' WHEN 'O' THEN 'One Way' END
                   AS trip_route_category,
               CASE WHEN o_orderstatus = 'P' THEN 'Month' ELSE 'Year' END AS passholder_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'standard' WHEN '2-HIGH' THEN 'Standard'
                    WHEN '3-MEDIUM' THEN 'electric' WHEN '4-NOT SPECIFIED' THEN 'classic' END
                   AS bike_type
        FROM orders)"""


def trip_moves(lineitem: DataFrame) -> DataFrame:
    """Line items as moves between stations: supplier to (part mod 100)."""
    return lineitem.select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_linenumber").alias("leg"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_suppkey").cast("string").alias("start_station"),
        (F.col("l_partkey") % 100).cast("string").alias("end_station"),
    )


TRIP_MOVES_SQL = """
    moves AS (
        SELECT l_orderkey AS trip_id, l_linenumber AS leg, CAST(l_shipdate AS DATE) AS day,
               CAST(l_suppkey AS VARCHAR) AS start_station,
               CAST(l_partkey % 100 AS VARCHAR) AS end_station
        FROM lineitem)"""

# -- stations ------------------------------------------------------------------

# Balances spread the stations over every case of the merge:
#   below 1000         new: not in the dimension, listed today
#   1000 up to 3000    open and active, not listed any more
#   3000 up to 5000    open and inactive, listed again
#   5000 up to 7000    open and inactive, not listed
#   from 7000          open and active, listed
SCD_RUN_DATE = "1998-07-01"
SCD_RUN_TS = "1998-07-01 06:30:00"


def station_dimension(supplier: DataFrame) -> DataFrame:
    """Open versions, and the closed active one before each inactive one."""
    balance = F.col("s_acctbal")
    inactive = (balance >= 3000) & (balance < 7000)

    def version(active, start, end):
        return F.struct(
            F.col("s_suppkey").cast("string").alias("station_id"),
            F.col("s_name").alias("name"),
            F.lit(-75.0).alias("lon"),
            F.lit(40.0).alias("lat"),
            F.lit("dock").alias("station_type"),
            F.concat(F.lit("old "), F.col("s_nationkey").cast("string")).alias("address"),
            active.alias("active_status"),
            start.alias("start_date"),
            end.alias("end_date"),
            F.lit("1997-01-01 00:00:00").cast("timestamp").alias("last_updated"),
        )

    opened = F.date_add(F.lit("1995-06-01").cast("date"), F.col("s_nationkey") * 10)
    paused = F.lit("1997-01-01").cast("date")
    open_end = F.lit(None).cast("date")
    first = F.when(inactive, version(F.lit(True), opened, paused))
    now = F.when(inactive, version(F.lit(False), paused, open_end)).otherwise(
        version(F.lit(True), opened, open_end)
    )
    return (
        supplier.filter(balance >= 1000)
        .select(F.explode(F.array_compact(F.array(first, now))).alias("v"))
        .select("v.*")
    )


def station_snapshot(supplier: DataFrame) -> DataFrame:
    balance = F.col("s_acctbal")
    listed = (balance < 1000) | ((balance >= 3000) & (balance < 5000)) | (balance >= 7000)
    return supplier.filter(listed).select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.when(F.col("s_nationkey") % 4 != 0, F.upper("s_name")).alias("name"),
        F.lit(-75.5).alias("lon"),
        F.when(F.col("s_nationkey") > 5, 40.5).alias("lat"),
        F.lit("dock").alias("station_type"),
        F.when(F.col("s_nationkey") % 3 != 0, F.concat(F.lit("new "), F.col("s_nationkey").cast("string"))).alias("address"),
        F.lit(True).alias("active_status"),
    )


STATIONS_SQL = f"""
    known AS (
        SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name,
               CAST(-75.0 AS DOUBLE) AS lon, CAST(40.0 AS DOUBLE) AS lat,
               'dock' AS station_type, 'old ' || CAST(s_nationkey AS VARCHAR) AS address,
               DATE '1995-06-01' + s_nationkey * 10 AS opened,
               s_acctbal >= 3000 AND s_acctbal < 7000 AS paused
        FROM supplier WHERE s_acctbal >= 1000),
    dim AS (
        SELECT station_id, name, lon, lat, station_type, address, NOT paused AS active_status,
               CASE WHEN paused THEN DATE '1997-01-01' ELSE opened END AS start_date,
               CAST(NULL AS DATE) AS end_date, TIMESTAMP '1997-01-01 00:00:00' AS last_updated
        FROM known
        UNION ALL
        SELECT station_id, name, lon, lat, station_type, address, TRUE, opened,
               DATE '1997-01-01', TIMESTAMP '1997-01-01 00:00:00'
        FROM known WHERE paused),
    snapshot AS (
        SELECT CAST(s_suppkey AS VARCHAR) AS station_id,
               CASE WHEN s_nationkey % 4 <> 0 THEN upper(s_name) END AS name,
               CAST(-75.5 AS DOUBLE) AS lon,
               CASE WHEN s_nationkey > 5 THEN CAST(40.5 AS DOUBLE) END AS lat,
               'dock' AS station_type,
               CASE WHEN s_nationkey % 3 <> 0 THEN 'new ' || CAST(s_nationkey AS VARCHAR) END AS address,
               TRUE AS active_status
        FROM supplier
        WHERE s_acctbal < 1000 OR (s_acctbal >= 3000 AND s_acctbal < 5000) OR s_acctbal >= 7000)"""

# By case of where a station is found: in today's list, else in the dimension only.
RECONCILED_SQL = f"""
    {STATIONS_SQL.strip()},
    opened AS (SELECT * FROM dim WHERE end_date IS NULL),
    listed AS (
        SELECT n.* REPLACE (
                   CASE WHEN n.name IS NULL THEN o.name ELSE n.name END AS name,
                   CASE WHEN n.address IS NULL THEN o.address ELSE n.address END AS address,
                   CASE WHEN n.lat IS NULL THEN o.lat ELSE n.lat END AS lat), o.start_date
        FROM snapshot n LEFT JOIN opened o USING (station_id)),
    gone AS (
        SELECT * EXCLUDE (end_date, last_updated) REPLACE (FALSE AS active_status)
        FROM opened WHERE station_id NOT IN (SELECT station_id FROM snapshot)),
    reconciled AS (
        SELECT * FROM listed
        UNION ALL BY NAME SELECT * FROM gone)"""

# The merge spelled out by case, in other words than the operator's single join.
MERGED_SQL = f"""
    {RECONCILED_SQL.strip()},
    merged AS (
        SELECT station_id, name, lon, lat, station_type, address, active_status, start_date,
               CASE WHEN end_date IS NOT NULL THEN end_date
                    WHEN NOT EXISTS (SELECT 1 FROM reconciled r
                                     WHERE r.station_id = dim.station_id
                                       AND r.active_status = dim.active_status
                                       AND r.start_date = dim.start_date)
                    THEN DATE '{SCD_RUN_DATE}' END AS end_date,
               CASE WHEN end_date IS NOT NULL THEN last_updated
                    ELSE TIMESTAMP '{SCD_RUN_TS}' END AS last_updated
        FROM dim
        UNION ALL
        SELECT station_id, name, lon, lat, station_type, address, active_status,
               DATE '{SCD_RUN_DATE}', NULL, TIMESTAMP '{SCD_RUN_TS}'
        FROM reconciled r
        WHERE NOT EXISTS (SELECT 1 FROM dim
                          WHERE dim.end_date IS NULL AND dim.station_id = r.station_id
                            AND dim.active_status = r.active_status
                            AND dim.start_date = r.start_date))"""

# -- weather -------------------------------------------------------------------


def weather_staging(events: DataFrame) -> DataFrame:
    """Hourly weather in the staging shape, every row loaded twice.

    The second load corrects the first, whose temperature is a degree too low.  It
    lacks the temperature of some hours, which only the first load has, and
    others lack it in both.  Temperatures come from whole cents, so that no sum
    depends on its order.
    """
    cents = F.round(F.col("value") * 100).cast("bigint")
    hourly = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at")).agg(
        F.sum(cents).alias("cents"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "signup").alias("signups"),
    )
    right = F.floor(F.col("cents") / F.col("n"))
    first = F.when(F.col("n") % 7 != 0, (right - 100) / 100)
    second = F.when((F.col("n") % 7 != 0) & (F.col("n") % 5 != 0), right / 100)
    return hourly.select(
        "*", F.explode(F.array(F.lit("2024-01-01"), F.lit("2024-01-02"))).alias("load_id")
    ).select(
        "load_id",
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ssxxx").alias("date"),
        F.when(F.col("load_id") == "2024-01-01", first).otherwise(second).alias("temperature_2m"),
        F.col("n").cast("int").alias("relative_humidity_2m"),
        F.greatest(F.lit(0), F.col("errors") - 2).cast("double").alias("rain"),
        F.greatest(F.lit(0), F.col("signups") - 3).cast("double").alias("snowfall"),
        F.lit(50).alias("cloud_cover"),
    )


WEATHER_SQL = f"""
    hourly AS (
        SELECT date_trunc('hour', ts) AS instant, sum(CAST(round(value * 100) AS BIGINT)) AS cents,
               count(*) AS n, count(*) FILTER (event_type = 'error') AS errors,
               count(*) FILTER (event_type = 'signup') AS signups
        FROM events GROUP BY 1),
    weather AS (
        SELECT date_trunc('hour', {LOCAL.format('instant')}) AS hour,
               CASE WHEN n % 7 = 0 THEN NULL
                    WHEN n % 5 = 0 THEN (floor(CAST(cents AS DOUBLE) / n) - 100) / 100
                    ELSE floor(CAST(cents AS DOUBLE) / n) / 100 END AS temperature_2m,
               CAST(greatest(0, errors - 2) AS DOUBLE) AS rain,
               CAST(greatest(0, signups - 3) AS DOUBLE) AS snowfall
        FROM hourly),
    demand AS (
        SELECT date_trunc('hour', ts) AS hour, count(*) AS n_trips
        FROM events GROUP BY 1),
    both_hours AS (
        SELECT weather.*, coalesce(n_trips, 0) AS trips
        FROM weather LEFT JOIN demand USING (hour)
        WHERE weather.hour >= (SELECT min(hour) FROM demand)
          AND weather.hour <= (SELECT max(hour) FROM demand))"""
