"""Trips: load, fact, demand and utilisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotide.operators.trips import trip_fact, trips_with_stations
from velotide.plans import demand, stations
from velotide.registry import feeds
from velotide.registry.base import query, table
from velotide.sources.feeds import good_trips, read_trip_lines, read_trips, trip_rejects
from velotide.sources.files import scratch_dir
from velotide.sources.tables import rebuild


@query(
    "trip_csv_load",
    "orders",
    oracle=f"WITH {feeds.TRIP_STAGING_SQL} SELECT * FROM staging",
)
def _trip_csv_load(spark, sf_dir):
    """Quarterly files, written and read back through one glob."""
    path = scratch_dir(spark, "trip_csv")
    trips = feeds.trip_staging(table(spark, sf_dir, "orders"))
    quarter = F.concat_ws("q", F.year("start_time"), F.quarter("start_time"))
    (
        trips.withColumn("quarter", quarter)
        .write.partitionBy("quarter")
        .option("header", True)
        .csv(path)
    )
    return read_trips(spark, f"{path}/quarter=*")


@query(
    "trip_csv_rejects",
    "orders",
    oracle=f"""WITH {feeds.TRIP_STAGING_SQL}
        SELECT trip_id, start_station, duration, CAST(NULL AS INTEGER) AS columns FROM staging
        WHERE plan_duration = 365
        UNION ALL
        SELECT trip_id, NULL, NULL, CASE WHEN bike_type IS NULL THEN 2 ELSE 11 END
        FROM staging WHERE plan_duration = 30""",
)
def _trip_csv_rejects(spark, sf_dir):
    """Files in which the trips of monthly plans are broken: no number, or most columns lacking."""
    path = scratch_dir(spark, "trip_csv")
    trips = feeds.trip_staging(table(spark, sf_dir, "orders"))
    monthly, short = F.col("plan_duration") == 30, F.col("bike_type").isNull()
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in trips.columns]
    broken = [F.when(monthly, "a month").otherwise(f) if c == "plan_duration" else f
              for c, f in zip(trips.columns, fields, strict=True)]
    line = F.when(monthly & short, F.concat_ws(",", "trip_id", F.lit("cut off"))).otherwise(F.concat_ws(",", *broken))
    trips.select(line.alias(",".join(trips.columns))).write.option("header", True).option("sep", "\u0001").csv(path)
    stored = rebuild(read_trip_lines(spark, path), scratch_dir(spark, "trip_lines"))
    bad = F.split("line", ",")
    rejects = trip_rejects(stored).select(
        bad[0].alias("trip_id"), F.lit(None).cast("string").alias("start_station"),
        F.lit(None).cast("int").alias("duration"), F.size(bad).alias("columns"),
    )
    good = good_trips(stored).select("trip_id", "start_station", "duration")
    return good.withColumn("columns", F.lit(None).cast("int")).unionByName(rejects)


@query(
    "trip_fact",
    "orders",
    oracle=f"""WITH {feeds.TRIP_STAGING_SQL}
        SELECT o_orderkey AS trip_id, s.* EXCLUDE (trip_id, trip_route_category, bike_type),
               -- by the order a trip was made from: its status and its priority
               map {{'F': TRUE, 'O': FALSE}}[o_orderstatus] AS is_round_trip,
               map {{'1': 'classic', '2': 'Standard', '3': 'electric', '4': 'classic'}}
                   [o_orderpriority[1]] AS bike_type
        FROM orders JOIN staging s ON s.trip_id = o_orderkey::VARCHAR""",
)
def _trip_fact(spark, sf_dir):
    fact = trip_fact(feeds.trip_staging(table(spark, sf_dir, "orders")))
    return rebuild(fact, scratch_dir(spark, "fct_trip_data"))


@query(
    "demand_by_hour",
    "events",
    oracle="SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips FROM events GROUP BY 1",
)
def _demand_by_hour(spark, sf_dir):
    return demand.demand_by_hour(feeds.trip_starts(table(spark, sf_dir, "events")))


@query(
    "demand_increments",
    "events",
    oracle="""
        SELECT CASE WHEN grouping(dow) = 1 THEN 'hour' WHEN grouping(hour) = 1 THEN 'dow'
                    ELSE 'dow_hour' END AS level, dow, hour, count(*) AS trips
        FROM (SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(hour(ts) AS INTEGER) AS hour FROM events)
        GROUP BY GROUPING SETS ((dow), (hour), (dow, hour))""",
)
def _demand_increments(spark, sf_dir):
    """The counts of three loads, by ten days of the month; the second is loaded twice."""
    path = scratch_dir(spark, "agg_demand")
    trips = feeds.trip_starts(table(spark, sf_dir, "events"))
    third = F.least(F.lit(2), F.floor((F.dayofmonth("start_time") - 1) / 10))
    for load in (0, 1, 2, 1):
        demand.load_demand(trips.where(third == load), path, f"part-{load}")
    levels = {name: demand.stored_demand(spark, path, name) for name in (demand.BY_HOUR, demand.BY_DOW, demand.BY_DOW_HOUR)}
    out = None
    for name, counts in levels.items():
        rows = counts.withColumn("level", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("level", "dow", "hour", "trips")


@query(
    "demand_by_dow",
    "events",
    oracle="""
        SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, count(*) AS trips
        FROM events GROUP BY 1""",
)
def _demand_by_dow(spark, sf_dir):
    return demand.demand_by_dow(feeds.trip_starts(table(spark, sf_dir, "events")))


@query(
    "demand_dow_hour",
    "events",
    oracle="""
        SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(hour(ts) AS INTEGER) AS hour,
               count(*) AS trips
        FROM events GROUP BY 1, 2""",
)
def _demand_dow_hour(spark, sf_dir):
    return demand.demand_dow_hour(feeds.trip_starts(table(spark, sf_dir, "events")))


@query(
    "peak_hours",
    "events",
    oracle="""
        SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips
        FROM events GROUP BY 1 ORDER BY trips DESC, hour LIMIT 3""",
)
def _peak_hours(spark, sf_dir):
    return demand.peak_hours(feeds.trip_starts(table(spark, sf_dir, "events")), 3)


_UTILISATION_SQL = f"""{feeds.TRIP_MOVES_SQL},
    ends AS (
        SELECT start_station AS station_id, 1 AS o, 0 AS i FROM moves
        UNION ALL SELECT end_station, 0, 1 FROM moves),
    util AS (
        SELECT station_id, CAST(sum(o) AS BIGINT) AS trips_out, CAST(sum(i) AS BIGINT) AS trips_in,
               CAST(sum(o) + sum(i) AS BIGINT) AS total, CAST(sum(i) - sum(o) AS BIGINT) AS net_flow
        FROM ends GROUP BY 1)"""


def _utilisation(spark, sf_dir):
    return stations.station_utilisation(feeds.trip_moves(table(spark, sf_dir, "lineitem")))


@query(
    "station_utilisation", "lineitem", oracle=f"WITH {_UTILISATION_SQL} SELECT * FROM util"
)
def _station_utilisation(spark, sf_dir):
    return _utilisation(spark, sf_dir)


@query(
    "utilisation_tier",
    "lineitem",
    oracle=f"""WITH {_UTILISATION_SQL},
        cuts AS (SELECT quantile_cont(total, 0.1) AS low, quantile_cont(total, 0.9) AS high FROM util)
        SELECT util.*, CASE WHEN total >= high THEN 'over' WHEN total <= low THEN 'under'
                            ELSE 'normal' END AS tier
        FROM util, cuts""",
)
def _utilisation_tier(spark, sf_dir):
    return stations.utilisation_tier(_utilisation(spark, sf_dir))


@query(
    "utilisation_load_tiers",
    "lineitem",
    oracle=f"""WITH {feeds.TRIP_MOVES_SQL},
        ends AS (
            SELECT year(day) AS y, start_station AS station_id FROM moves
            UNION ALL SELECT year(day), end_station FROM moves),
        totals AS (SELECT y, station_id, count(*) AS total FROM ends GROUP BY ALL)
        SELECT CAST(y AS VARCHAR) AS load_id, count(*) AS stations, CAST(sum(total) AS BIGINT) AS trip_ends,
               TRUE AS low_is_right, TRUE AS high_is_right
        FROM totals GROUP BY 1""",
)
def _utilisation_load_tiers(spark, sf_dir):
    """Totals by year, the years loaded one by one and one of them twice, and whether the ranks of the
    cuts from merged sketches are within a hundredth of the tenth and ninetieth percentile."""
    path = scratch_dir(spark, "station_totals")
    moves = feeds.trip_moves(table(spark, sf_dir, "lineitem"))
    years = [r[0] for r in moves.select(F.year("day").alias("y")).distinct().orderBy("y").collect()]
    for year in [*years, *years[:1]]:
        stations.load_station_totals(moves.where(F.year("day").eqNullSafe(F.lit(year))), path, str(year))
    tiers = stations.load_tiers(spark, path)
    cuts = stations.stored_cuts(spark, path)

    def right(name, q):
        cut = cuts.select(name).scalar()
        below, up_to = (F.avg(x.cast("double")) for x in (F.col("total") < cut, F.col("total") <= cut))
        return tiers.agg(((below <= q + 0.01) & (up_to >= q - 0.01)).alias("right")).scalar()

    loads = tiers.groupBy("load_id").agg(F.count(F.lit(1)).alias("stations"), F.sum("total").alias("trip_ends"))
    return loads.withColumns({"low_is_right": right("low", 0.1), "high_is_right": right("high", 0.9)})


@query(
    "busiest_stations",
    "lineitem",
    oracle=f"WITH {_UTILISATION_SQL} SELECT * FROM util ORDER BY total DESC, station_id LIMIT 10",
)
def _busiest_stations(spark, sf_dir):
    return stations.busiest_stations(_utilisation(spark, sf_dir), 10)


@query(
    "star_join",
    "lineitem",
    "supplier",
    "nation",
    oracle=f"""WITH {feeds.TRIP_MOVES_SQL},
        st AS (
            SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, n_name AS area
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
        SELECT m.*, s.name AS start_name, s.area AS start_area, e.name AS end_name, e.area AS end_area
        FROM moves m LEFT JOIN st s ON s.station_id = m.start_station
                     LEFT JOIN st e ON e.station_id = m.end_station""",
)
def _star_join(spark, sf_dir):
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    named = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left").select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("area"),
    )
    moves = feeds.trip_moves(table(spark, sf_dir, "lineitem"))
    return trips_with_stations(moves, named, ("name", "area"))
