"""Does the weather affect demand?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions import clock

BAND_DEGREES = 10


def weather_by_local_hour(weather: DataFrame, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    """One weather row per wall-clock hour; unknown values are NULL.

    An instant that was loaded more than once keeps its most complete row, and of
    equally complete ones that of the latest ``load_id`` (if there is one).  The
    two instants that share the autumn clock-change hour are then averaged, so
    that joining trips by wall-clock hour counts no trip twice.
    """
    series = ["temperature_2m", "rain", "snowfall"]
    known = sum((F.col(c).isNotNull().cast("int") for c in series), F.lit(0))
    load = F.col("load_id").cast("string") if "load_id" in weather.columns else F.lit("")
    # A maximum, unlike a row number, combines before the shuffle without a sort.
    best = F.max(F.struct(known.alias("known"), load.alias("load"), *series)).alias("best")
    once = weather.groupBy("date").agg(best).select("date", "best.*")
    hour = clock.local_hour(clock.to_local(F.to_timestamp("date"), zone))
    return once.groupBy(hour.alias("hour")).agg(
        F.avg("temperature_2m").alias("temperature_2m"),
        F.avg("rain").alias("rain"),
        F.avg("snowfall").alias("snowfall"),
    )


def hourly_demand_with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per wall-clock hour beside that hour's weather.

    Every hour of known weather from the first trip's to the last trip's counts,
    with 0 trips where there were none: weather that stops all riding shows up as
    such.  Both sides are aggregated to one row per hour before they meet.
    """
    demand = trips.groupBy(clock.local_hour(F.col("start_time")).alias("hour")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    first = demand.select(F.min("hour")).scalar()
    last = demand.select(F.max("hour")).scalar()
    hours = weather_by_local_hour(weather).filter(F.col("hour").between(first, last))
    return hours.join(demand, "hour", "left").withColumn("trips", F.coalesce("trips", F.lit(0)))


def weather_demand(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Mean hourly trips by temperature band (its lower bound), rain and snow.

    Hours of which one of these is unknown are groups of their own, with NULL.
    """
    band = (F.floor(F.col("temperature_2m") / BAND_DEGREES) * BAND_DEGREES).cast("int")
    return (
        hourly_demand_with_weather(trips, weather)
        .groupBy(
            band.alias("temperature_band"),
            (F.col("rain") > 0).alias("is_rain"),
            (F.col("snowfall") > 0).alias("is_snow"),
        )
        .agg(
            F.count(F.lit(1)).alias("hours"),
            F.avg("trips").alias("mean_trips"),
        )
    )


def _corr(x: str, y: str) -> Column:
    """Pearson correlation over rows that know both; NaN where one does not vary (say, no snow).

    The built-in ``corr`` divides by zero there, which ANSI mode makes an error.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.when(spread == 0, F.lit(float("nan"))).otherwise(F.covar_pop(x, y) / spread)


def weather_corr(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Correlation over hours of trips with temperature, rain and snowfall."""
    return hourly_demand_with_weather(trips, weather).agg(
        _corr("trips", "temperature_2m").alias("corr_temperature"),
        _corr("trips", "rain").alias("corr_rain"),
        _corr("trips", "snowfall").alias("corr_snowfall"),
    )
