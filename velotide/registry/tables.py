"""Load dispositions, schema hints and dated snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.registry import feeds
from velotide.registry.base import query, table
from velotide.sources import snapshots, tables, versions
from velotide.sources.files import scratch_dir


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )


_CUSTOMERS_SQL = "SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
_SUPPLIERS_SQL = "SELECT 'supplier' AS kind, s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier"


@query("load_truncate", "customer", "supplier", oracle=_CUSTOMERS_SQL)
def _load_truncate(spark, sf_dir):
    """The second load replaces the first."""
    path = scratch_dir(spark, "truncate")
    tables.load(_suppliers(spark, sf_dir), path, tables.TRUNCATE)
    tables.load(_customers(spark, sf_dir), path, tables.TRUNCATE)
    return versions.read(spark, path)


@query(
    "load_append",
    "customer",
    "supplier",
    oracle=f"{_CUSTOMERS_SQL} UNION ALL {_SUPPLIERS_SQL} UNION ALL {_SUPPLIERS_SQL}",
)
def _load_append(spark, sf_dir):
    """Appending the same rows twice holds them twice."""
    path = scratch_dir(spark, "append")
    tables.load(_suppliers(spark, sf_dir), path, tables.APPEND)
    tables.load(_customers(spark, sf_dir), path, tables.APPEND)
    tables.load(_suppliers(spark, sf_dir), path, tables.APPEND)
    return versions.read(spark, path)


@query("load_empty", "customer", "supplier", oracle=_CUSTOMERS_SQL)
def _load_empty(spark, sf_dir):
    """An existing table without rows takes the load; after that it refuses."""
    path = scratch_dir(spark, "empty")
    customers = _customers(spark, sf_dir)
    tables.load(customers.filter(F.lit(False)), path, tables.TRUNCATE)
    tables.load(customers, path, tables.EMPTY)
    try:
        tables.load(_suppliers(spark, sf_dir), path, tables.EMPTY)
    except tables.TableNotEmptyError:
        pass
    return versions.read(spark, path)


@query(
    "schema_hints",
    "supplier",
    oracle="""
        SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, s_acctbal AS lon,
               CAST(s_nationkey AS VARCHAR) AS station_type, s_name AS address,
               s_acctbal >= 0 AS active_status
        FROM supplier""",
)
def _schema_hints(spark, sf_dir):
    """Keys arrive as numbers and the status as 0/1; the longitude keeps its type."""
    stations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lon"),
        F.col("s_nationkey").alias("station_type"),
        F.col("s_name").alias("address"),
        (F.col("s_acctbal") >= 0).cast("int").alias("active_status"),
    )
    base = scratch_dir(spark, "warehouse")
    tables.load_table(stations, base, "stations_info")
    return tables.read_table(spark, base, "stations_info")


@query(
    "snapshot_write_once",
    "supplier",
    oracle=f"""WITH {feeds.STATIONS_SQL}
        SELECT station_id, name, lon, lat, station_type, address, active_status FROM snapshot""",
)
def _snapshot_write_once(spark, sf_dir):
    """The second snapshot of the same day, with other content, is skipped."""
    base = scratch_dir(spark, "snapshots")
    first = feeds.station_snapshot(table(spark, sf_dir, "supplier"))
    snapshots.snapshot_csv(first, base, "2024-01-30")
    snapshots.snapshot_csv(first.withColumn("name", F.lit("changed")), base, "2024-01-30")
    return spark.read.schema(first.schema).csv(f"{base}/stations_info_2024-01-30", header=True)


_RUN_DATE = "2024-01-30"


@query(
    "snapshot_expiry",
    "events",
    oracle=f"""
        SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day
        FROM events WHERE CAST(ts AS DATE) > DATE '{_RUN_DATE}' - 7""",
)
def _snapshot_expiry(spark, sf_dir):
    """Daily folders of the whole table; those of 7 days and more are deleted."""
    base = scratch_dir(spark, "expiry")
    daily = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    tables.load(daily, base, tables.TRUNCATE, partition_by=["day"])
    snapshots.expire(spark, versions.current(spark, base), _RUN_DATE)
    return versions.read(spark, base)


@query(
    "snapshot_unexpired",
    "events",
    oracle=f"""
        SELECT event_id, CAST(ts AS DATE) AS day
        FROM events WHERE CAST(ts AS DATE) > DATE '{_RUN_DATE}' - 7""",
)
def _snapshot_unexpired(spark, sf_dir):
    daily = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    return snapshots.unexpired(daily, "day", _RUN_DATE)
