"""Dated snapshots: written once, expired by age."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.functions.clock import as_date
from velotide.sources import files

# Fixed values.
SNAPSHOT_PREFIX = "stations_info_"
RETENTION_DAYS = 7


def snapshot_csv(
    df: DataFrame, base: str, run_date: dt.date | str, prefix: str = SNAPSHOT_PREFIX
) -> bool:
    """Write the snapshot of ``run_date`` unless it is there; True if written.

    Presence means a committed write.  What a broken run left behind is
    replaced, which ``mode("ignore")`` would keep for ever.
    """
    path = f"{base}/{prefix}{as_date(run_date).isoformat()}"
    if files.is_complete(df.sparkSession, path):
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def unexpired(
    df: DataFrame, column: str, run_date: dt.date | str, days: int = RETENTION_DAYS
) -> DataFrame:
    """Rows younger than ``days``; prunes folders when ``column`` partitions."""
    oldest = as_date(run_date) - dt.timedelta(days=days)
    return df.filter(F.col(column) > F.lit(oldest))


def expire(
    spark: SparkSession, base: str, run_date: dt.date | str, days: int = RETENTION_DAYS
) -> list[str]:
    """Delete the dated folders below ``base`` aged ``days`` or more.

    Dated is a name that ends in a date, such as ``stations_info_2024-01-30`` or
    ``day=2024-01-30``.  Only names are listed; no data is read or rewritten.
    """
    oldest = as_date(run_date) - dt.timedelta(days=days)
    expired = []
    for name in files.subdirectories(spark, base):
        match = re.search(r"[=_](\d{4}-\d{2}-\d{2})$", name)
        if match and dt.date.fromisoformat(match.group(1)) <= oldest:
            files.delete(spark, f"{base}/{name}")
            expired.append(name)
    return expired
