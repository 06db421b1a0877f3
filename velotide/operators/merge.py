"""Insert-only merge and the daily increment of the status fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide import schemas
from velotide.functions import clock
from velotide.operators.dedup import dedup_keep_one
from velotide.sources import files
from velotide.sources.tables import write_partitioned

STATUS_KEY = ["station_id", "utc_timestamp"]
FACT_COLUMNS = schemas.FACT_STATUS.fieldNames()


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold.

    A key with a NULL part matches nothing, so such rows are always returned.
    """
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_only_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Target plus the unmatched source rows.  Existing rows never change."""
    return target.unionByName(unmatched(target, source, keys))


def status_fact_rows(staging: DataFrame, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    """Staging rows in the shape of the fact; the three flags are dropped."""
    return staging.withColumn(
        "est_datetime", clock.to_local(F.col("utc_timestamp"), zone)
    ).select(*FACT_COLUMNS)


def _once(staging: DataFrame) -> DataFrame:
    return dedup_keep_one(staging.select(*STATUS_KEY, *schemas.MEASURES), STATUS_KEY)


def status_new_rows(
    fact: DataFrame,
    staging: DataFrame,
    run_date: dt.date | str,
    days: int | None = 1,
    zone: str = clock.LOCAL_ZONE,
) -> DataFrame:
    """What the run of ``run_date`` inserts into the status fact.

    Deduplicated on station and instant, local date within the window, not yet
    in the fact.  Both inputs are cut to the window first, by folder where they
    are stored by date (``utc_date``, ``est_date``), so a run reads a few days of
    each however long the history is.  Deduplication and merge share their key
    and with it one shuffle of the staging rows.  ``days=None`` is a back-fill: it
    has no window and takes all that is staged.
    """
    if days is None:
        return unmatched(fact, status_fact_rows(_once(staging), zone), STATUS_KEY)
    utc_date = "utc_date" if "utc_date" in staging.columns else None
    staged = clock.near_window(staging, "utc_timestamp", run_date, days, utc_date)
    once = _once(staged)
    # The window depends on the key alone, so Spark filters before deduplicating;
    # the wall-clock time itself is neither sorted nor shuffled.
    fresh = clock.in_window(status_fact_rows(once, zone), "est_datetime", run_date, days)

    known = clock.near_window(fact, "utc_timestamp", run_date, days)
    if "est_date" in fact.columns:
        known = clock.in_window(known, "est_date", run_date, days)
    return unmatched(known, fresh, STATUS_KEY)


def status_increment(
    fact: DataFrame,
    staging: DataFrame,
    run_date: dt.date | str,
    days: int = 1,
    zone: str = clock.LOCAL_ZONE,
) -> DataFrame:
    """The status fact after the run of ``run_date``."""
    new = status_new_rows(fact, staging, run_date, days, zone)
    return fact.select(*FACT_COLUMNS).unionByName(new)


_STORED = T.StructType([*schemas.FACT_STATUS, T.StructField("est_date", T.DateType())])


def read_status_fact(
    spark: SparkSession, path: str, dates: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """The stored fact with its folder column ``est_date``; empty if absent.

    With ``dates``, only the folders of those local dates are listed and read.
    """
    if dates is not None:
        folders = files.day_folders(spark, path, "est_date", *dates)
    else:
        folders = [path] if files.exists(spark, path) else []
    if not folders:
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).option("basePath", path).parquet(*folders)


def load_status_increment(
    staging: DataFrame,
    path: str,
    run_date: dt.date | str,
    days: int | None = 1,
    zone: str = clock.LOCAL_ZONE,
) -> None:
    """Append the new rows to the stored fact, partitioned by local date.

    Running it again for the same day, after success or after a failure half way
    through the append, finds the rows already there and adds only the rest.
    Two runs must not overlap in time: neither would see the other's rows.
    """
    spark = staging.sparkSession
    dates = None if days is None else clock.window(run_date, days)
    fact = read_status_fact(spark, path, dates)
    new = status_new_rows(fact, staging, run_date, days, zone)
    dated = new.withColumn("est_date", F.to_date("est_datetime"))
    write_partitioned(dated, path, "append", ["est_date"])
