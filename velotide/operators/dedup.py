"""One row per key, and checks that keys are unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A merge source holds more than one row for a key."""


def dedup_keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep the first row per key.

    By default that is one with the fewest unknown (NULL) values, and of these
    the least by all other columns: a full reading beats a broken copy of it, and
    the survivor is the same on every run.  Spark limits each
    key to its first row before the shuffle as well as after it, so a key with
    very many copies does not travel whole.
    """
    if order is None:
        others = [c for c in df.columns if c not in keys]
        known = [F.col(c).isNotNull().cast("int") for c in others]
        order = [sum(known, F.lit(0)).desc(), *[F.col(c).asc_nulls_last() for c in others]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or keys)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count ``n``.

    A key with a NULL part matches nothing in a merge and is no conflict.
    """
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def assert_unique(df: DataFrame, keys: Sequence[str], show: int = 20) -> None:
    """Raise, naming up to ``show`` keys, if the merge source is ambiguous."""
    found = key_conflicts(df, keys).limit(show).collect()
    if found:
        named = ", ".join(str({k: row[k] for k in keys} | {"rows": row["n"]}) for row in found)
        raise DuplicateKeyError(f"more than one row for {named}")
