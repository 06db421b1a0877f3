"""Do the feeds agree on their station keys?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_reconcile(feeds: dict[str, DataFrame], key: str = "station_id") -> DataFrame:
    """Keys that at least one feed lacks, with ``rows_<feed>`` per feed.

    One grouping over all feeds together, counted before the shuffle, in place
    of an anti join per pair.  A NULL key matches nothing, so it is reported
    wherever it occurs.
    """
    counts = [f"rows_{name}" for name in feeds]
    tagged = [
        df.select(
            F.col(key).alias("station_id"),
            *[F.lit(1 if name == mine else 0).alias(f"rows_{name}") for name in feeds],
        )
        for mine, df in feeds.items()
    ]
    per_key = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("station_id")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return per_key.filter(F.col("station_id").isNull() | (F.least(*counts) == 0))
