"""Station keys.  The feeds use two different rules; both are kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the two rules.
DIGITS = r"(\d+)"
SUFFIX_LENGTH = 4


def station_key_digits(station_id: Column) -> Column:
    """First run of digits; '' where there is none, NULL for NULL."""
    return F.regexp_extract(station_id, DIGITS, 0)


def station_key_suffix(station_id: Column, length: int = SUFFIX_LENGTH) -> Column:
    """Last four characters, or ``length``; a shorter text comes back whole."""
    return F.substring(station_id, -length, length)
