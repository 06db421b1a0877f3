"""Session settings the operators rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from velotide.sources import files

# Results depend on the first two: instants are formatted and shifted from UTC,
# and a bad cast has to fail rather than turn into NULL.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Speed depends on these: runtime re-planning, splitting of hot join partitions
# (also where the join feeds an aggregate on the same key) and of hot output
# partitions.  The default form of stored instants, INT96, carries no minimum and
# maximum, so that filters on them could skip nothing.
PLAN_SETTINGS = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024
# Rows in memory against the compressed files they come from.
EXPANSION = 4


def build_session(
    app_name: str = "velotide",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or get) a session; ``settings`` win over the defaults here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {
        "spark.ui.enabled": "false",
        **RESULT_SETTINGS,
        **PLAN_SETTINGS,
        **(settings or {}),
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings on a session somebody else has started."""
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str, expansion: float = EXPANSION) -> Iterator[int]:
    """Within, a shuffle starts with one partition per 128 MB of the inputs.

    The fixed default of 200 would put hundreds of GB into each partition of a
    100 TB shuffle.  Small partitions are merged again at run time, so starting
    high costs little.  Never goes below the session's own setting, which holds
    again afterwards.  ``expansion`` is the size of the rows shuffled against
    that of the files at ``paths``.
    """
    total = int(expansion * sum(files.total_bytes(spark, path) for path in paths))
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(total // BYTES_PER_SHUFFLE_PARTITION + 1, configured)
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    try:
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
