"""Weather rows, and demand against weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.plans import weather
from velotide.registry import feeds
from velotide.registry.base import query, rounded, table
from velotide.sources import tables
from velotide.sources.feeds import weather_rows
from velotide.sources.files import scratch_dir

_STEPS = 6


@query(
    "weather_rows",
    "events",
    oracle=f"""
        SELECT strftime(date_trunc('hour', ts) + to_hours(CAST(i AS INTEGER)), '%Y-%m-%dT%H:%M:%S')
                   || '+00:00' AS date,
               CASE WHEN event_type <> 'click' THEN CAST(CAST(value + i AS FLOAT) AS DOUBLE)
                   END AS temperature_2m,
               CASE WHEN event_type <> 'error' THEN CAST(trunc(CAST(value + i / 2 AS FLOAT)) AS INTEGER)
                   END AS relative_humidity_2m,
               CAST(CAST(value / 10 AS FLOAT) AS DOUBLE) AS rain,
               CAST(0 AS DOUBLE) AS snowfall, CAST(i * 10 AS INTEGER) AS cloud_cover
        FROM events, range(0, {_STEPS}) AS steps(i)""",
)
def _weather_rows(spark, sf_dir):
    """One six-hour report per event; humidity and temperature are NaN for an event type each."""
    start = F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp")))

    def series(value):
        return F.array(*[value(i).cast("float") for i in range(_STEPS)])

    def temperature(i):
        known = F.col("event_type") != "click"
        return F.when(known, F.col("value") + i).otherwise(float("nan"))

    def humidity(i):
        known = F.col("event_type") != "error"
        return F.when(known, F.col("value") + i / 2).otherwise(float("nan"))

    reports = table(spark, sf_dir, "events").select(
        start.alias("start"),
        (start + _STEPS * 3600).alias("end"),
        F.lit(3600).alias("interval_s"),
        series(temperature).alias("temperature_2m"),
        series(humidity).alias("relative_humidity_2m"),
        series(lambda i: F.col("value") / 10).alias("rain"),
        series(lambda i: F.lit(0)).alias("snowfall"),
        series(lambda i: F.lit(i * 10)).alias("cloud_cover"),
    )
    return weather_rows(reports)


def _trips_and_weather(spark, sf_dir):
    """Trips, and the weather as staged by an appending load.

    Staging it also keeps the plans apart: on the bare stand-in, Spark would
    evaluate the weather's join key for every event it is made from.
    """
    events = table(spark, sf_dir, "events")
    base = scratch_dir(spark, "weather")
    tables.load_table(feeds.weather_staging(events), base, "weather", tables.APPEND)
    return feeds.trip_starts(events), tables.read_table(spark, base, "weather")


@query(
    "weather_demand",
    "events",
    oracle=f"""WITH {feeds.WEATHER_SQL}
        SELECT CAST(floor(temperature_2m / 10) * 10 AS INTEGER) AS temperature_band,
               rain > 0 AS is_rain, snowfall > 0 AS is_snow, count(*) AS hours,
               round(avg(trips), 10) AS mean_trips
        FROM both_hours GROUP BY 1, 2, 3""",
)
def _weather_demand(spark, sf_dir):
    return rounded(weather.weather_demand(*_trips_and_weather(spark, sf_dir)), "mean_trips")


@query(
    "weather_corr",
    "events",
    oracle=f"""WITH {feeds.WEATHER_SQL}
        SELECT round(corr(trips, temperature_2m), 8) AS corr_temperature,
               round(corr(trips, rain), 8) AS corr_rain,
               round(corr(trips, snowfall), 8) AS corr_snowfall
        FROM both_hours""",
)
def _weather_corr(spark, sf_dir):
    corr = weather.weather_corr(*_trips_and_weather(spark, sf_dir))
    return corr.select(*[F.round(c, 8).alias(c) for c in corr.columns])
