"""How demand varies over hours and weekdays (Sunday = 1).

A trip counts when it starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.sources import tables, versions


def demand_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.hour("start_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def demand_by_dow(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.dayofweek("start_time").alias("dow")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def demand_dow_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy(
        F.dayofweek("start_time").alias("dow"), F.hour("start_time").alias("hour")
    ).agg(F.count(F.lit(1)).alias("trips"))


def peak_hours(trips: DataFrame, k: int) -> DataFrame:
    """The ``k`` hours with most trips; the earlier hour wins a tie."""
    return demand_by_hour(trips).orderBy(F.desc("trips"), F.asc("hour")).limit(k)


# -- kept up to date -----------------------------------------------------------

#: Which of the questions a stored count belongs to.
BY_HOUR, BY_DOW, BY_DOW_HOUR = "hour", "dow", "dow_hour"


def demand_counts(trips: DataFrame) -> DataFrame:
    """(level, dow, hour, trips) for all three questions, from one pass over the trips."""
    timed = trips.select(F.dayofweek("start_time").alias("dow"), F.hour("start_time").alias("hour"))
    # The bits of the id say which of (dow, hour) a row is not grouped by.
    level = F.element_at(F.array(*map(F.lit, (BY_DOW_HOUR, BY_DOW, BY_HOUR))), (F.grouping_id() + 1).cast("int"))
    sets = [[F.col("hour")], [F.col("dow")], [F.col("dow"), F.col("hour")]]
    return timed.groupingSets(sets, "dow", "hour").agg(level.alias("level"), F.count(F.lit(1)).alias("trips")).select(
        "level", "dow", "hour", "trips"
    )


def load_demand(trips: DataFrame, path: str, load_id: str) -> None:
    """Add the counts of a load of trips (a day, a quarter) to the stored ones.

    Only the new trips are read.  A load owns its counts: the same ``load_id`` again
    replaces them.
    """
    tables.load(demand_counts(trips), path, tables.APPEND, load_id=load_id)


def stored_demand(spark: SparkSession, path: str, level: str) -> DataFrame:
    """``demand_by_hour``, ``demand_by_dow`` or ``demand_dow_hour`` over all loads.

    Reads some 200 rows per load, whatever the number of trips.
    """
    columns = {BY_HOUR: ["hour"], BY_DOW: ["dow"], BY_DOW_HOUR: ["dow", "hour"]}[level]
    counts = versions.read(spark, path).where(F.col("level") == level)
    return counts.groupBy(*columns).agg(F.sum("trips").alias("trips"))
