"""Status payloads to flat rows.  One narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide import schemas
from velotide.functions import clock, values
from velotide.functions.keys import station_key_digits


def station_list() -> Column:
    """The station array of the payload in ``value``, NULL where it has none.

    Garbage, cut-off JSON and documents without a station list all give NULL;
    a field of the wrong type only nulls that field.
    """
    parsed = F.from_json(F.col("value").cast("string"), schemas.STATUS_PAYLOAD)
    return parsed["data"]["stations"]


def decode_status(payloads: DataFrame) -> DataFrame:
    """One row per station of each payload in ``value`` (text or bytes).

    Payloads without stations give no row; ``status_rejects`` returns those that
    could not be decoded.  Works on a batch and on a stream.
    """
    # Exploding the expression, not a column that holds it: for a column Spark
    # adds a filter on its size below, which would parse each payload twice.
    return payloads.select(F.explode(station_list()).alias("s")).select(
        clock.epoch_to_utc(F.col("s.last_reported")).alias("utc_timestamp"),
        station_key_digits(F.col("s.station_id")).alias("station_id"),
        values.flag(F.col("s.is_returning")).alias("is_returning"),
        values.flag(F.col("s.is_renting")).alias("is_renting"),
        values.flag(F.col("s.is_installed")).alias("is_installed"),
        F.col("s.num_docks_available").alias("num_docks_available"),
        F.col("s.num_bikes_available").alias("num_bikes_available"),
        F.col("s.num_bikes_available_types.electric").alias("num_bikes_available_electric"),
        F.col("s.num_bikes_available_types.smart").alias("num_bikes_available_smart"),
        F.col("s.num_bikes_available_types.classic").alias("num_bikes_available_classic"),
    )


def status_rejects(payloads: DataFrame) -> DataFrame:
    """The payloads without a readable station list, all their columns kept.

    An empty list is readable and no reject.
    """
    return payloads.filter(station_list().isNull())
