"""Small value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the trip feed.
ROUND_TRIP = "Round Trip"
OLD_CLASSIC = "standard"
CLASSIC = "classic"


def flag(number: Column) -> Column:
    """0/1 integer to boolean; NULL stays NULL."""
    return number == 1


def number(value: Column) -> Column:
    """As a double; NaN, which would count as a value, becomes NULL."""
    return F.when(~F.isnan(value), value.cast("double"))


def whole_number(number: Column) -> Column:
    """Truncate toward zero; NaN and values out of range become NULL.

    NaN is common in the feed and is tested first: ``try_cast`` alone would raise
    and catch an exception for every one.
    """
    return F.when(~F.isnan(number), number.try_cast("int"))


def is_round_trip(category: Column) -> Column:
    return category == ROUND_TRIP


def bike_kind(bike_type: Column) -> Column:
    """The old name becomes the new one; all else, NULL too, passes."""
    return F.when(bike_type == OLD_CLASSIC, CLASSIC).otherwise(bike_type)
