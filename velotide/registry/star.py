"""From the feeds to the star schema and an answer, through the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.operators.scd import scd_current
from velotide.plans import availability, stations, warehouse, weather
from velotide.registry import feeds
from velotide.registry.base import query, rounded, table, table_stream
from velotide.sources.files import scratch_dir
from velotide.streaming import ingest

RUN_DATE = "2024-01-30"
# The characters of a bigint at most: the stations' ids are their keys, which differ as a whole.
KEY_LENGTH = 20


@query(
    "warehouse_day",
    "events",
    "orders",
    "supplier",
    oracle=f"""WITH {feeds.DECODED_SQL},
        readings AS (
            SELECT DISTINCT station_id, utc_timestamp, num_bikes_available AS bikes,
                   num_docks_available AS docks
            FROM decoded WHERE station_id <> ''),
        once AS (
            SELECT station_id, utc_timestamp, bikes, docks
            FROM (SELECT *, row_number() OVER (PARTITION BY station_id, utc_timestamp
                                               ORDER BY docks, bikes) AS r FROM readings)
            WHERE r = 1),
        fill AS (
            SELECT station_id, count(*) AS readings,
                   round(avg(CAST(bikes AS DOUBLE) / (bikes + docks)), 10) AS fill_ratio
            FROM once GROUP BY 1),
        {feeds.TRIP_STAGING_SQL},
        ends AS (
            SELECT start_station AS station_id FROM staging
            UNION ALL SELECT end_station FROM staging),
        trips AS (SELECT station_id, count(*) AS total FROM ends GROUP BY 1)
        SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, readings, fill_ratio, total
        FROM supplier
        LEFT JOIN fill ON fill.station_id = CAST(s_suppkey AS VARCHAR)
        LEFT JOIN trips ON trips.station_id = CAST(s_suppkey AS VARCHAR)""",
)
def _warehouse_day(spark, sf_dir):
    """Land all feeds, run the daily jobs, and put fill beside use per station."""
    base = scratch_dir(spark, "warehouse")
    stream = table_stream(spark, sf_dir, "events")
    ingest.append_status(
        feeds.status_payloads(stream), f"{base}/{warehouse.STATUS_STAGING}", f"{base}/checkpoint"
    ).awaitTermination()
    warehouse.load_status(spark, base, RUN_DATE, days=None)

    feeds.trip_staging(table(spark, sf_dir, "orders")).write.option("header", True).csv(
        f"{base}/trip_csv"
    )
    warehouse.load_trips(spark, f"{base}/trip_csv", base)

    station = F.struct(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lon"),
        F.lit(40.0).alias("lat"),
        F.lit("dock").alias("_bcycle_station_type"),
        F.lit("street").alias("address"),
    )
    document = F.to_json(F.struct(F.struct(F.array(station).alias("stations")).alias("data")))
    table(spark, sf_dir, "supplier").select(document.alias("value")).write.text(f"{base}/info")
    warehouse.load_stations(
        spark, f"{base}/info", base, RUN_DATE, f"{RUN_DATE} 06:00:00",
        whole_files=False, key_length=KEY_LENGTH,
    )

    fill = availability.station_fill(warehouse.read_status(spark, base))
    use = stations.station_utilisation(warehouse.read_trip_fact(spark, base))
    current = scd_current(warehouse.read_dimension(spark, base)).select("station_id", "name")
    joined = current.join(rounded(fill, "fill_ratio"), "station_id", "left").join(
        use, "station_id", "left"
    )
    return joined.select("station_id", "name", "readings", "fill_ratio", "total")


@query(
    "warehouse_weather",
    "orders",
    oracle=f"""WITH {feeds.TRIP_STAGING_SQL},
        days AS (SELECT DISTINCT CAST(start_time AS DATE) AS day FROM staging),
        steps AS (
            SELECT CAST(day AS TIMESTAMP) + to_hours(CAST(i AS INTEGER)) AS moment,
                   CAST((dayofyear(day) * 7 + i) % 40 - 5 AS DOUBLE) AS temperature,
                   CASE WHEN (dayofyear(day) + i) % 5 = 0 THEN 1.0 ELSE 0.0 END AS rain,
                   CASE WHEN dayofyear(day) * i % 11 = 0 THEN 0.5 ELSE 0.0 END AS snowfall
            FROM days, range(0, 24) h(i)),
        hours AS (
            SELECT date_trunc('hour', {feeds.LOCAL.format('moment')}) AS hour, avg(temperature) AS temperature,
                   avg(rain) AS rain, avg(snowfall) AS snowfall
            FROM steps GROUP BY 1),
        demand AS (SELECT date_trunc('hour', start_time) AS hour, count(*) AS n FROM staging GROUP BY 1),
        both_hours AS (
            SELECT hours.*, coalesce(n, 0) AS trips FROM hours LEFT JOIN demand USING (hour)
            WHERE hour BETWEEN (SELECT min(hour) FROM demand) AND (SELECT max(hour) FROM demand))
        SELECT CAST(floor(temperature / 10) * 10 AS INTEGER) AS temperature_band, rain > 0 AS is_rain,
               snowfall > 0 AS is_snow, count(*) AS hours, round(avg(trips), 10) AS mean_trips
        FROM both_hours GROUP BY 1, 2, 3""",
)
def _warehouse_weather(spark, sf_dir):
    """The weather branch of the daily run: reports of all days loaded, the last day twice, and
    demand against weather from the stored tables."""
    base = scratch_dir(spark, "warehouse")
    trips = feeds.trip_staging(table(spark, sf_dir, "orders"))
    trips.write.option("header", True).csv(f"{base}/trip_csv")
    warehouse.load_trips(spark, f"{base}/trip_csv", base)

    day = F.col("day").cast("timestamp")
    number = F.dayofyear("day")

    def series(value):
        return F.array(*[value(i).cast("float") for i in range(24)])

    reports = trips.select(F.to_date("start_time").alias("day")).distinct().select(
        F.unix_seconds(day).alias("start"),
        (F.unix_seconds(day) + 24 * 3600).alias("end"),
        F.lit(3600).alias("interval_s"),
        series(lambda i: (number * 7 + i) % 40 - 5).alias("temperature_2m"),
        series(lambda i: F.lit(50)).alias("relative_humidity_2m"),
        series(lambda i: F.when((number + i) % 5 == 0, 1.0).otherwise(0.0)).alias("rain"),
        series(lambda i: F.when(number * i % 11 == 0, 0.5).otherwise(0.0)).alias("snowfall"),
        series(lambda i: F.lit(20)).alias("cloud_cover"),
    )
    for _ in range(2):
        warehouse.load_weather(reports, base, RUN_DATE)
    answer = weather.weather_demand(warehouse.read_trip_fact(spark, base), warehouse.read_weather(spark, base))
    return rounded(answer, "mean_trips")
