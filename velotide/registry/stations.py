"""Station info, the type-2 dimension and key reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from velotide.functions.keys import station_key_digits, station_key_suffix
from velotide.operators import history, scd
from velotide.operators.reconcile import key_reconcile
from velotide.registry import feeds
from velotide.registry.base import query, table
from velotide.sources.feeds import read_station_info, station_rejects, station_rows
from velotide.sources.files import scratch_dir
from velotide.sources.snapshots import snapshot_csv
from velotide.sources.tables import rebuild


def _station_documents(spark, sf_dir):
    """One document per supplier, written as text and read as the feed.

    Some documents lack the address.
    """
    path = scratch_dir(spark, "station_info")
    station = F.struct(
        F.col("s_name").alias("station_id"),
        F.concat(F.lit("Stop "), F.col("s_suppkey").cast("string")).alias("name"),
        F.col("s_acctbal").alias("lon"),
        F.col("s_nationkey").cast("double").alias("lat"),
        F.lit("dock").alias("_bcycle_station_type"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("address"),
    )
    document = F.to_json(F.struct(F.struct(F.array(station).alias("stations")).alias("data")))
    table(spark, sf_dir, "supplier").select(document.alias("value")).write.text(path)
    return read_station_info(spark, path, whole_files=False)


@query(
    "station_snapshot",
    "supplier",
    oracle="""
        SELECT right(s_name, 4) AS station_id, 'Stop ' || CAST(s_suppkey AS VARCHAR) AS name,
               s_acctbal AS lon, CAST(s_nationkey AS DOUBLE) AS lat, 'dock' AS station_type,
               s_name AS address, TRUE AS active_status
        FROM supplier WHERE s_acctbal >= 0""",
)
def _station_snapshot(spark, sf_dir):
    return station_rows(_station_documents(spark, sf_dir))


@query(
    "station_rejects",
    "supplier",
    oracle="""
        SELECT s_name AS station_id, 'Stop ' || CAST(s_suppkey AS VARCHAR) AS name,
               s_acctbal AS lon, CAST(s_nationkey AS DOUBLE) AS lat,
               'dock' AS _bcycle_station_type, CAST(NULL AS VARCHAR) AS address
        FROM supplier WHERE s_acctbal < 0""",
)
def _station_rejects(spark, sf_dir):
    return station_rejects(_station_documents(spark, sf_dir))


def _dim_and_snapshot(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    return feeds.station_dimension(supplier), feeds.station_snapshot(supplier)


def _merged(spark, sf_dir):
    return scd.scd2_merge(*_dim_and_snapshot(spark, sf_dir), feeds.SCD_RUN_DATE, feeds.SCD_RUN_TS)


@query(
    "scd_reconcile",
    "supplier",
    oracle=f"WITH {feeds.RECONCILED_SQL} SELECT * FROM reconciled",
)
def _scd_reconcile(spark, sf_dir):
    return scd.scd_reconcile(*_dim_and_snapshot(spark, sf_dir))


@query("scd2_merge", "supplier", oracle=f"WITH {feeds.MERGED_SQL} SELECT * FROM merged")
def _scd2_merge(spark, sf_dir):
    return _merged(spark, sf_dir)


@query(
    "scd_current",
    "supplier",
    oracle=f"WITH {feeds.MERGED_SQL} SELECT * FROM merged WHERE end_date IS NULL",
)
def _scd_current(spark, sf_dir):
    return scd.scd_current(_merged(spark, sf_dir))


# Stations listed on three days in turn, by balance: all, those above 3000, those
# below 7000.  The days lie a year apart.
_STORED_RUNS = [
    ("1996-01-01", "true"),
    ("1997-01-01", "s_acctbal >= 3000"),
    ("1998-01-01", "s_acctbal < 7000"),
]


_STORED_SQL = """
        WITH s AS (
            SELECT CAST(s_suppkey AS VARCHAR) AS station_id,
                   s_acctbal >= 3000 AS second, s_acctbal < 7000 AS third
            FROM supplier),
        v AS (
            SELECT station_id, TRUE AS active_status, DATE '1996-01-01' AS start_date,
                   CASE WHEN NOT second THEN DATE '1997-01-01'
                        WHEN NOT third THEN DATE '1998-01-01' END AS end_date
            FROM s
            UNION ALL
            SELECT station_id, FALSE, DATE '1997-01-01',
                   CASE WHEN third THEN DATE '1998-01-01' END
            FROM s WHERE NOT second
            UNION ALL
            SELECT station_id, NOT second, DATE '1998-01-01', NULL
            FROM s WHERE second <> third)
        SELECT * FROM v"""


def _listed_station(supplier, listed):
    return supplier.filter(listed).select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.lit(-75.0).alias("lon"),
        F.lit(40.0).alias("lat"),
        F.lit("dock").alias("station_type"),
        F.col("s_name").alias("address"),
        F.lit(True).alias("active_status"),
    )


def _statuses(dim):
    return dim.select("station_id", "active_status", "start_date", "end_date")


@query("scd2_stored", "supplier", oracle=_STORED_SQL)
def _scd2_stored(spark, sf_dir):
    """Three runs against the stored dimension, the last one run twice."""
    path = scratch_dir(spark, "dim_stations")
    supplier = table(spark, sf_dir, "supplier")
    for day, listed in [*_STORED_RUNS, _STORED_RUNS[-1]]:
        scd.apply_snapshot(_listed_station(supplier, listed), path, day, f"{day} 06:00:00")
    return _statuses(scd.read_stations(spark, path))


@query("scd2_late", "supplier", oracle=_STORED_SQL)
def _scd2_late(spark, sf_dir):
    """The same three runs, the middle one put in late, and then the last one run again."""
    path, kept = scratch_dir(spark, "dim_stations"), scratch_dir(spark, "snapshots")
    supplier = table(spark, sf_dir, "supplier")
    first, middle, last = _STORED_RUNS
    for day, listed in (first, last):
        snapshot = _listed_station(supplier, listed)
        scd.apply_snapshot(snapshot, path, day, f"{day} 06:00:00")
        snapshot_csv(snapshot, kept, day)
    snapshot_csv(_listed_station(supplier, middle[1]), kept, middle[0])
    history.put_in_late(spark, path, kept, middle[0], f"{middle[0]} 06:00:00")
    scd.apply_snapshot(_listed_station(supplier, last[1]), path, last[0], f"{last[0]} 06:00:00")
    return _statuses(scd.read_stations(spark, path))


_SNAPSHOT_DAYS = {dt.date(1996, 1, 1) + dt.timedelta(days=9 * k): k for k in range(1, 13)}


@query(
    "scd2_from_snapshots",
    "supplier",
    oracle="""
        WITH seen AS (
            SELECT s_suppkey AS station, k, DATE '1996-01-01' + 9 * k AS day,
                   (s_suppkey * 7 + k * 3) % 5 <> 0 AND s_nationkey <> k AS listed,
                   s_name || ' ' || k AS name,
                   CASE WHEN (s_suppkey + k) % 3 <> 0 THEN 'street ' || k END AS address,
                   (s_suppkey + k) % 11 <> 0 AND (s_suppkey + k) % 7 <> 0 AS working
            FROM supplier, (SELECT unnest(range(1, 13))::INTEGER AS k)),
        known AS (
            SELECT *, listed AND working AS active FROM seen s
            WHERE k >= (SELECT min(k) FROM seen f WHERE f.station = s.station AND f.listed)),
        compared AS (
            SELECT *, lag(active) OVER (PARTITION BY station ORDER BY k) AS was FROM known),
        starts AS (SELECT * FROM compared WHERE was IS NULL OR was <> active)
        SELECT CAST(station AS VARCHAR) AS station_id, active AS active_status, day AS start_date,
               lead(day) OVER w AS end_date,
               last_value(CASE WHEN listed THEN name END IGNORE NULLS) OVER w AS name,
               last_value(CASE WHEN listed THEN address END IGNORE NULLS) OVER w AS address,
               coalesce(lead(day) OVER w, DATE '1996-01-01' + 108) + INTERVAL 6 HOUR AS last_updated
        FROM starts WINDOW w AS (PARTITION BY station ORDER BY k)""",
)
def _scd2_from_snapshots(spark, sf_dir):
    """Twelve dated snapshots, from which stations are missing in turn, to all versions at once."""
    supplier = table(spark, sf_dir, "supplier")
    days = F.explode(F.array(*[F.struct(F.lit(d).alias("day"), F.lit(k).alias("k")) for d, k in _SNAPSHOT_DAYS.items()]))
    station = F.col("s_suppkey")
    listed = supplier.select("*", days.alias("d")).select("*", "d.*").where(
        ((station * 7 + F.col("k") * 3) % 5 != 0) & (F.col("s_nationkey") != F.col("k"))
    )
    turn = station + F.col("k")
    snapshots = listed.select(
        F.col("day").alias(history.DAY),
        station.cast("string").alias("station_id"),
        F.concat("s_name", F.lit(" "), F.col("k").cast("string")).alias("name"),
        F.lit(-75.0).alias("lon"),
        F.lit(40.0).alias("lat"),
        F.lit("dock").alias("station_type"),
        F.when(turn % 3 != 0, F.concat(F.lit("street "), F.col("k").cast("string"))).alias("address"),
        F.when(turn % 11 != 0, turn % 7 != 0).alias("active_status"),
    )
    dim = history.versions_of(snapshots, {d: f"{d} 06:00:00" for d in _SNAPSHOT_DAYS})
    return dim.select("station_id", "active_status", "start_date", "end_date", "name", "address", "last_updated")


_AS_OF_SQL = f"""WITH {feeds.MERGED_SQL}, {feeds.TRIP_MOVES_SQL}
        SELECT m.trip_id, m.leg, m.day, m.start_station, d.name, d.active_status, d.start_date
        FROM moves m LEFT JOIN merged d
          ON d.station_id = m.start_station AND d.start_date <= m.day
         AND (d.end_date IS NULL OR m.day < d.end_date)"""


@query("scd_as_of", "lineitem", "supplier", oracle=_AS_OF_SQL)
def _scd_as_of(spark, sf_dir):
    """The dimension is stored first: the lookup measures it and then reads it."""
    moves = feeds.trip_moves(table(spark, sf_dir, "lineitem")).drop("end_station")
    dim = rebuild(_merged(spark, sf_dir), scratch_dir(spark, "dim_stations"))
    return scd.scd_as_of(moves, dim, "day", key="start_station")


@query("scd_as_of_sorted", "lineitem", "supplier", oracle=_AS_OF_SQL)
def _scd_as_of_sorted(spark, sf_dir):
    moves = feeds.trip_moves(table(spark, sf_dir, "lineitem")).drop("end_station")
    return scd.scd_as_of_sorted(moves, _merged(spark, sf_dir), "day", key="start_station")


@query(
    "key_reconcile",
    "events",
    "lineitem",
    "supplier",
    oracle="""
        WITH k AS (
            SELECT regexp_extract('hub_' || CAST(user_id AS VARCHAR), '\\d+', 0) AS id,
                   1 AS s, 0 AS t, 0 AS d FROM events
            UNION ALL SELECT CAST(l_suppkey AS VARCHAR), 0, 1, 0 FROM lineitem
            UNION ALL SELECT CAST(l_partkey AS VARCHAR), 0, 1, 0 FROM lineitem
            UNION ALL SELECT right(s_name, 4), 0, 0, 1 FROM supplier),
        p AS (SELECT lpad(id, greatest(4, CAST(length(id) AS INTEGER)), '0') AS station_id, s, t, d FROM k)
        SELECT station_id, CAST(sum(s) AS BIGINT) AS rows_status,
               CAST(sum(t) AS BIGINT) AS rows_trips, CAST(sum(d) AS BIGINT) AS rows_stations
        FROM p GROUP BY 1 HAVING least(sum(s), sum(t), sum(d)) = 0""",
)
def _key_reconcile(spark, sf_dir):
    """Keys of the three feeds, with leading zeros up to four digits.

    Stations are keyed by the last four characters, so keys of more digits show
    up here as the mismatch they are.
    """

    def padded(key):
        return F.lpad(key, F.greatest(F.lit(4), F.length(key)), F.lit("0"))

    def text(column):
        return F.col(column).cast("string")

    status = table(spark, sf_dir, "events").select(
        padded(station_key_digits(F.concat(F.lit("hub_"), text("user_id")))).alias("station_id")
    )
    trips = table(spark, sf_dir, "lineitem").select(
        F.explode(F.array(padded(text("l_suppkey")), padded(text("l_partkey")))).alias("station_id")
    )
    stations = table(spark, sf_dir, "supplier").select(
        station_key_suffix(F.col("s_name")).alias("station_id")
    )
    return key_reconcile({"status": status, "trips": trips, "stations": stations})
