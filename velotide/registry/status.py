"""Status feed: payloads, stream, deduplication and the daily increment."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.functions import clock
from velotide.operators.decode import decode_status, station_list, status_rejects
from velotide.operators.dedup import dedup_keep_one, key_conflicts
from velotide.operators.drift import schema_drift
from velotide.operators.merge import (
    FACT_COLUMNS,
    STATUS_KEY,
    load_status_increment,
    read_status_fact,
    status_increment,
)
from velotide.plans import availability
from velotide.registry import feeds
from velotide.registry.base import query, rounded, table, table_stream
from velotide.sources import buckets
from velotide.sources.files import scratch_dir
from velotide.streaming import distinct, ingest, landed

RUN_DATE = "2024-01-30"
RUN_BEFORE = "2024-01-29"
BUCKETS = 8


@query(
    "status_decode",
    "events",
    oracle=f"WITH {feeds.DECODED_SQL} SELECT * FROM decoded",
)
def _status_decode(spark, sf_dir):
    return decode_status(feeds.status_payloads(table(spark, sf_dir, "events")))


@query(
    "status_rejects",
    "events",
    oracle="SELECT event_id, ts AS ingest_ts FROM events WHERE event_type = 'signup'",
)
def _status_rejects(spark, sf_dir):
    payloads = feeds.status_payloads(table(spark, sf_dir, "events"))
    return status_rejects(payloads).select("event_id", "ingest_ts")


_DOCKS, _SMART = "data.stations[].num_docks_available", "data.stations[].num_bikes_available_types.smart"


@query(
    "payload_drift",
    "events",
    oracle=f"""
        WITH p AS (SELECT CAST(ts AS DATE) AS day, event_type AS t FROM events)
        SELECT day, kind, path, declared, found, payloads FROM (
            SELECT day, 'unreadable' AS kind, '$' AS path, NULL AS declared, NULL AS found, count(*) AS payloads
            FROM p WHERE t = 'signup' GROUP BY 1
            UNION ALL
            SELECT day, 'unknown', path, NULL, found, count(*)
            FROM p, (VALUES ('region', 'OBJECT'), ('region.name', 'STRING')) f(path, found)
            WHERE t = 'view' GROUP BY ALL
            UNION ALL
            SELECT day, 'retyped', '{_DOCKS}', 'int', 'STRING', count(*) FROM p WHERE t = 'click' GROUP BY 1
            UNION ALL
            SELECT DISTINCT day, 'missing', '{_SMART}', 'int', NULL, 0 FROM p)""",
)
def _payload_drift(spark, sf_dir):
    """Payloads of which some have a new field, some a count as text, some are cut off."""
    events = table(spark, sf_dir, "events")
    text = F.col("value").cast("string")
    payloads = feeds.status_payloads(events).join(events.select("event_id", "event_type"), "event_id")
    new = F.regexp_replace(text, '"version":"1.1"', '"version":"1.1","region":{"name":"north"}')
    typed = F.regexp_replace(text, r'"num_docks_available":(\d+)', r'"num_docks_available":"$1"')
    kind = F.col("event_type")
    value = F.when(kind == "view", new).when(kind == "click", typed).otherwise(text)
    drifting = payloads.select(value.alias("value"), F.to_date("ingest_ts").alias("day"))
    return schema_drift(drifting, by=["day"])


@query(
    "raw_landing",
    "events",
    oracle="""
        SELECT CAST(ts AS DATE) AS ingest_date, count(*) AS payloads,
               count(*) FILTER (event_type = 'signup') AS rejects,
               2 * count(*) FILTER (event_type <> 'signup') AS stations
        FROM events GROUP BY 1""",
)
def _raw_landing(spark, sf_dir):
    """Land the stream of payloads, then count what each day's folder holds."""
    path = scratch_dir(spark, "raw")
    payloads = feeds.status_payloads(table_stream(spark, sf_dir, "events"))
    ingest.land_raw(payloads, path, f"{path}-checkpoint").awaitTermination()
    sizes = spark.read.parquet(path).select("ingest_date", F.size(station_list()).alias("size"))
    return sizes.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(F.col("size").isNull()).alias("rejects"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("stations"),
    )


@query(
    "status_stream_append",
    "events",
    oracle=f"""WITH {feeds.DECODED_SQL}
        SELECT *, CAST(utc_timestamp AS DATE) AS utc_date FROM decoded""",
)
def _status_stream_append(spark, sf_dir):
    path = scratch_dir(spark, "status")
    payloads = feeds.status_payloads(table_stream(spark, sf_dir, "events"))
    ingest.append_status(payloads, path, f"{path}-checkpoint").awaitTermination()
    return ingest.read_status_table(spark, path)


@query(
    "status_stream_distinct",
    "events",
    oracle=f"""WITH {feeds.DECODED_SQL}
        SELECT DISTINCT station_id, utc_timestamp, CAST(utc_timestamp AS DATE) AS utc_date FROM decoded""",
)
def _status_stream_distinct(spark, sf_dir):
    """Each station and time of reading once, and what the stream left out as late."""
    path = scratch_dir(spark, "status")
    payloads = feeds.status_payloads(table_stream(spark, sf_dir, "events"))
    distinct.append_distinct_status(payloads, path, f"{path}-checkpoint").awaitTermination()
    kept = ingest.read_status_table(spark, path)
    late = distinct.late_readings(feeds.status_payloads(table(spark, sf_dir, "events")), kept)
    every = kept.unionByName(late.withColumn("utc_date", F.to_date("utc_timestamp")))
    return every.select("station_id", "utc_timestamp", "utc_date")


@query(
    "status_stream_latest",
    "events",
    oracle="""
        SELECT CAST(ts + to_days(later) AS DATE) AS ingest_date, count(*) AS payloads
        FROM events, (VALUES (1), (2)) l(later) GROUP BY 1""",
)
def _status_stream_latest(spark, sf_dir):
    """A stream of landed payloads that starts after the first of three landings and restarts once.

    The payloads land three times, a day later each time; the first landing is history.
    """
    raw, path = scratch_dir(spark, "raw"), scratch_dir(spark, "replayed")
    for later in range(3):
        payloads = feeds.status_payloads(table_stream(spark, sf_dir, "events"))
        arrived = F.col("ingest_ts") + F.expr(f"interval {later} days")
        ingest.land_raw(payloads.withColumn("ingest_ts", arrived), raw, f"{raw}-checkpoint-{later}").awaitTermination()
        replayed = landed.read_landed_stream(spark, raw, f"{path}-checkpoint")
        ingest.land_raw(replayed, path, f"{path}-checkpoint").awaitTermination()
    rows = spark.read.schema("ingest_date date, value binary").parquet(path)
    return rows.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("payloads"))


@query(
    "utc_to_local",
    "events",
    oracle=f"""
        SELECT event_id, ts AS utc_timestamp, {feeds.LOCAL.format('ts')} AS est_datetime
        FROM events""",
)
def _utc_to_local(spark, sf_dir):
    instant = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        instant.alias("utc_timestamp"),
        clock.to_local(instant).alias("est_datetime"),
    )


@query(
    "incremental_window",
    "events",
    oracle=f"""WITH {feeds.STATUS_FACT_SQL}
        SELECT * FROM fact
        WHERE CAST(est_datetime AS DATE) BETWEEN DATE '{RUN_BEFORE}' AND DATE '{RUN_DATE}'""",
)
def _incremental_window(spark, sf_dir):
    fact = feeds.status_fact(table(spark, sf_dir, "events"))
    near = clock.near_window(fact, "utc_timestamp", RUN_DATE)
    return clock.in_window(near, "est_datetime", RUN_DATE)


# The fewest unknown values first, then the least values.
_COLUMNS = """num_docks_available, num_bikes_available, num_bikes_available_electric,
    num_bikes_available_smart, num_bikes_available_classic"""
_FULL_ORDER = f"len(list_filter([{_COLUMNS}], lambda x: x IS NULL)), " + ", ".join(
    f"{c.strip()} NULLS LAST" for c in _COLUMNS.split(",")
)

_DEDUPED_SQL = f"""{feeds.STATUS_REPEATED_SQL},
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY station_id, utc_timestamp
                                     ORDER BY {_FULL_ORDER}) AS r
        FROM repeated),
    deduped AS (SELECT * EXCLUDE (r) FROM ranked WHERE r = 1)"""


@query(
    "status_dedup",
    "events",
    oracle=f"WITH {_DEDUPED_SQL} SELECT * FROM deduped",
)
def _status_dedup(spark, sf_dir):
    return dedup_keep_one(feeds.status_repeated(table(spark, sf_dir, "events")), STATUS_KEY)


# The fact as the run before left it: all up to noon of that day, holding a
# reading that differs from the one staged now and must not be updated.
_LOADED_UNTIL = f"{RUN_BEFORE} 12:00:00"

_MEASURES = """num_docks_available, num_bikes_available, num_bikes_available_electric,
    num_bikes_available_smart, num_bikes_available_classic"""


_INCREMENT_SQL = f"""WITH {_DEDUPED_SQL},
        localised AS (
            SELECT {feeds.LOCAL.format('utc_timestamp')} AS est_datetime, station_id,
                   {_MEASURES}, utc_timestamp
            FROM deduped),
        loaded AS (
            SELECT * REPLACE (num_bikes_available + 5 AS num_bikes_available)
            FROM localised WHERE est_datetime < TIMESTAMP '{_LOADED_UNTIL}')
        SELECT * FROM loaded
        UNION ALL
        SELECT * FROM localised l
        WHERE CAST(est_datetime AS DATE) BETWEEN DATE '{RUN_BEFORE}' AND DATE '{RUN_DATE}'
          AND NOT EXISTS (SELECT 1 FROM loaded f
                          WHERE f.station_id = l.station_id
                            AND f.utc_timestamp = l.utc_timestamp)"""


def _loaded(events):
    """The fact as the run before left it."""
    loaded = feeds.status_fact(events).filter(
        F.col("est_datetime") < F.lit(_LOADED_UNTIL).cast("timestamp_ntz")
    )
    return loaded.withColumn("num_bikes_available", F.col("num_bikes_available") + 5)


@query("status_increment", "events", oracle=_INCREMENT_SQL)
def _status_increment(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return status_increment(_loaded(events), feeds.status_repeated(events), RUN_DATE)


@query("status_increment_bucketed", "events", oracle=_INCREMENT_SQL)
def _status_increment_bucketed(spark, sf_dir):
    """The same with the fact in buckets of its key; only what is staged is shuffled."""
    events = table(spark, sf_dir, "events")
    fact = buckets.store(_loaded(events), scratch_dir(spark, "fact"), STATUS_KEY, BUCKETS)
    return status_increment(fact, feeds.status_repeated(events), RUN_DATE)


@query(
    "status_increment_stored",
    "events",
    oracle=f"""WITH {_DEDUPED_SQL}
        SELECT {feeds.LOCAL.format('utc_timestamp')} AS est_datetime, station_id,
               {_MEASURES}, utc_timestamp,
               CAST({feeds.LOCAL.format('utc_timestamp')} AS DATE) AS est_date
        FROM deduped""",
)
def _status_increment_stored(spark, sf_dir):
    """Fill the stored fact: all history as a back-fill, then the last day twice."""
    path = scratch_dir(spark, "fct_stations_status")
    staging = feeds.status_repeated(table(spark, sf_dir, "events"))
    load_status_increment(staging, path, RUN_BEFORE, days=None)
    load_status_increment(staging, path, RUN_DATE)
    load_status_increment(staging, path, RUN_DATE)
    return read_status_fact(spark, path).select(*FACT_COLUMNS, "est_date")


@query(
    "merge_key_conflicts",
    "events",
    oracle="""
        SELECT CAST(user_id AS VARCHAR) AS station_id, date_trunc('hour', ts) AS hour, count(*) AS n
        FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _merge_key_conflicts(spark, sf_dir):
    readings = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("station_id"),
        clock.local_hour(F.col("ts")).alias("hour"),
    )
    return key_conflicts(readings, ["station_id", "hour"])


@query(
    "latest_status",
    "events",
    oracle=f"""WITH {feeds.STATUS_SQL},
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY station_id
                ORDER BY utc_timestamp DESC, is_returning DESC, is_renting DESC, is_installed DESC,
                         num_docks_available DESC, num_bikes_available DESC) AS r
            FROM status)
        SELECT * EXCLUDE (r) FROM ranked WHERE r = 1""",
)
def _latest_status(spark, sf_dir):
    return availability.latest_status(feeds.status_staging(table(spark, sf_dir, "events")))


@query(
    "availability_by_hour",
    "events",
    oracle=f"""WITH {feeds.STATUS_FACT_SQL}
        SELECT CAST(hour(est_datetime) AS INTEGER) AS hour,
               round(avg(num_bikes_available), 10) AS avg_bikes,
               round(avg(num_docks_available), 10) AS avg_docks
        FROM fact GROUP BY 1""",
)
def _availability_by_hour(spark, sf_dir):
    hourly = availability.availability_by_hour(feeds.status_fact(table(spark, sf_dir, "events")))
    return rounded(hourly, "avg_bikes", "avg_docks")


@query(
    "station_fill",
    "events",
    oracle=f"""WITH {feeds.STATUS_FACT_SQL}
        SELECT station_id, count(*) AS readings,
               round(avg(CASE WHEN num_bikes_available + num_docks_available <> 0
                              THEN CAST(num_bikes_available AS DOUBLE)
                                   / (num_bikes_available + num_docks_available) END), 10) AS fill_ratio,
               round(avg(CASE WHEN num_bikes_available = 0 THEN 1 ELSE 0 END), 10) AS empty_share,
               round(avg(CASE WHEN num_docks_available = 0 THEN 1 ELSE 0 END), 10) AS full_share
        FROM fact GROUP BY 1""",
)
def _station_fill(spark, sf_dir):
    fill = availability.station_fill(feeds.status_fact(table(spark, sf_dir, "events")))
    return rounded(fill, "fill_ratio", "empty_share", "full_share")


_SPANS_SQL = f"""{feeds.STATUS_FACT_SQL},
    seconds AS (SELECT *, CAST(floor(epoch(utc_timestamp)) AS BIGINT) AS since FROM fact),
    followed AS (
        SELECT *, lead(since) OVER (PARTITION BY station_id ORDER BY utc_timestamp) AS till FROM seconds),
    spans AS (SELECT * FROM followed WHERE till > since)"""


@query(
    "availability_weighted",
    "events",
    oracle=f"""WITH {_SPANS_SQL},
        cut AS (SELECT *, unnest(range(since - since % 3600, till, 3600)) AS moment FROM spans),
        pieces AS (
            SELECT hour({feeds.LOCAL.format('make_timestamp(moment * 1000000)')}) AS hour,
                   least(till, moment + 3600) - greatest(since, moment) AS seconds,
                   num_bikes_available AS bikes, num_docks_available AS docks
            FROM cut)
        SELECT CAST(hour AS INTEGER) AS hour, CAST(sum(seconds) AS BIGINT) AS seconds,
               round(CAST(sum(bikes * seconds) AS DOUBLE) / sum(seconds), 10) AS avg_bikes,
               round(CAST(sum(docks * seconds) AS DOUBLE) / sum(seconds), 10) AS avg_docks
        FROM pieces GROUP BY 1""",
)
def _availability_weighted(spark, sf_dir):
    fact = feeds.status_fact(table(spark, sf_dir, "events"))
    return rounded(availability.weighted_availability_by_hour(fact), "avg_bikes", "avg_docks")


@query(
    "station_fill_weighted",
    "events",
    oracle=f"""WITH {_SPANS_SQL},
        timed AS (
            SELECT station_id, till - since AS s, num_bikes_available AS bikes, num_docks_available AS docks,
                   bikes + docks AS places
            FROM spans)
        SELECT station_id, CAST(sum(s) AS BIGINT) AS seconds,
               round(sum(CASE WHEN places <> 0 THEN CAST(bikes AS DOUBLE) / places * s END)
                     / sum(CASE WHEN places <> 0 THEN s END), 10) AS fill_ratio,
               round(CAST(sum(CASE WHEN bikes = 0 THEN s ELSE 0 END) AS DOUBLE) / sum(s), 10) AS empty_share,
               round(CAST(sum(CASE WHEN docks = 0 THEN s ELSE 0 END) AS DOUBLE) / sum(s), 10) AS full_share
        FROM timed GROUP BY 1""",
)
def _station_fill_weighted(spark, sf_dir):
    fill = availability.weighted_station_fill(feeds.status_fact(table(spark, sf_dir, "events")))
    return rounded(fill, "fill_ratio", "empty_share", "full_share")


@query(
    "demand_vs_availability",
    "events",
    oracle=f"""WITH {feeds.STATUS_FACT_SQL},
        d AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips FROM events GROUP BY 1),
        a AS (SELECT CAST(hour(est_datetime) AS INTEGER) AS hour,
                     round(avg(num_bikes_available), 10) AS avg_bikes,
                     round(avg(num_docks_available), 10) AS avg_docks
              FROM fact GROUP BY 1)
        SELECT hour, coalesce(trips, 0) AS trips, avg_bikes, avg_docks FROM d FULL JOIN a USING (hour)""",
)
def _demand_vs_availability(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hourly = availability.demand_vs_availability(feeds.trip_starts(events), feeds.status_fact(events))
    return rounded(hourly, "avg_bikes", "avg_docks")
