"""Instants, wall-clock time and date windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the wall-clock zone of the network.
LOCAL_ZONE = "America/New_York"

# No zone is further than 14 hours from UTC, so one day covers every offset.
UTC_PAD_DAYS = 1


# Names of the zone the session must be in.
UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UTC+00:00"}


def require_utc() -> None:
    """Raise unless the session's zone is UTC.

    Instants are cut to dates, formatted and shifted by the session's zone.  In
    another one the results would be wrong without an error.
    """
    spark = SparkSession.getActiveSession()
    zone = spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"
    if zone not in UTC_NAMES:
        raise RuntimeError(f"the session's zone is {zone}; velotide.session.prepare sets UTC")


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def epoch_to_utc(seconds: Column) -> Column:
    """Epoch seconds to an instant, without a detour over local text."""
    return F.timestamp_seconds(seconds)


def to_local(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant to wall-clock time without zone.  Raises outside a UTC session.

    ``from_utc_timestamp`` looks its zone up once per task; ``convert_timezone``
    does so for every row and takes four times as long.
    """
    require_utc()
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def iso_utc(instant: Column) -> Column:
    """ISO-8601 text with a numeric offset (``+00:00``, never ``Z``)."""
    require_utc()
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ssxxx")


def local_hour(local: Column) -> Column:
    """Wall-clock time cut to the hour, still without zone."""
    return F.date_trunc("hour", local).cast("timestamp_ntz")


def window(
    run_date: dt.date | str, days: int = 1, pad: int = 0
) -> tuple[dt.date, dt.date]:
    """First and last local date of a run, widened by ``pad`` days at both ends."""
    last = as_date(run_date)
    return last - dt.timedelta(days=days + pad), last + dt.timedelta(days=pad)


def in_window(
    df: DataFrame, column: str, run_date: dt.date | str, days: int = 1
) -> DataFrame:
    """Rows whose local date lies in [run_date - days, run_date], ends included.

    ``run_date`` is a local date, given by the caller; nothing reads the clock.
    """
    first, last = window(run_date, days)
    return df.filter(F.to_date(column).between(F.lit(first), F.lit(last)))


def near_window(
    df: DataFrame,
    column: str,
    run_date: dt.date | str,
    days: int = 1,
    utc_date: str | None = None,
) -> DataFrame:
    """Coarse form of ``in_window`` on the stored instant.

    A superset of the window in any zone.  It compares the bare column with
    constants, so it reaches the Parquet reader and skips row groups, which the
    exact predicate on the converted time cannot do.  With ``utc_date``, the name
    of a column that holds the instant's UTC date, it skips folders as well.
    """
    require_utc()
    first, last = window(run_date, days, UTC_PAD_DAYS)
    after = last + dt.timedelta(days=1)
    near = (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after))
    if utc_date is not None:
        near = near & F.col(utc_date).between(F.lit(first), F.lit(last))
    return df.filter(near)
