"""Shapes of the physical plans."""

import datetime as dt

import pytest
from helpers import final_plan, rows
from pyspark.sql import functions as F

from velotide import schemas, session
from velotide.operators import dedup, merge, scd, sizing, trips
from velotide.operators.decode import decode_status, status_rejects
from velotide.plans import availability, demand, stations, warehouse
from velotide.registry import QUERIES, feeds
from velotide.registry.base import table
from velotide.schemas import DIM_STATIONS
from velotide.sources import files, tables

SF = "/root/testdata/sf0.01"


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_all_pairs_join_and_no_python(spark, name):
    plan = planned(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_only_bounded_rows_meet_in_one_task(spark, name):
    """One task may end an aggregate of the whole table, never a window or sort."""
    plan = planned(QUERIES[name](spark, SF))
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "Aggregate" in part.splitlines()[1] and "partial_" in part.splitlines()[1]


def test_decoding_is_narrow_and_parses_once(spark):
    payloads = feeds.status_payloads(table(spark, SF, "events"))
    for df in (decode_status(payloads), status_rejects(payloads)):
        plan = planned(df)
        assert "Exchange" not in plan
        evaluated = [line for line in plan.splitlines() if "FileScan" not in line]
        assert "\n".join(evaluated).count("from_json") == 1


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = planned(demand.demand_by_hour(feeds.trip_starts(table(spark, SF, "events"))))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_window_filter_reaches_the_reader(spark):
    plan = planned(QUERIES["incremental_window"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-28" in plan
    assert "LessThan(ts,2024-02-01" in plan


def test_merge_joins_once_and_leaves_history_alone(spark):
    supplier = table(spark, SF, "supplier")
    day, now = "2024-01-01", "2024-01-01 06:00:00"
    plan = planned(
        scd.scd2_merge(feeds.station_dimension(supplier), feeds.station_snapshot(supplier), day, now)
    )
    assert plan.count("FullOuter") == 1
    before, joined = plan.split("FullOuter")
    assert "Union" in before and "Exchange" not in before
    assert joined.count("Exchange") == 2


def test_increment_shuffles_the_staging_rows_once(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = planned(QUERIES["status_increment"](spark, SF))
    # one for the staging rows (deduplication and merge), one for the known keys
    assert plan.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in plan


def test_copies_are_limited_before_the_shuffle(spark):
    copies = feeds.status_repeated(table(spark, SF, "events"))
    plan = planned(dedup.dedup_keep_one(copies, ["station_id", "utc_timestamp"]))
    above, below = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below


def test_aggregates_combine_before_the_shuffle(spark):
    events, lineitem = table(spark, SF, "events"), table(spark, SF, "lineitem")
    for df, partial in (
        (availability.latest_status(feeds.status_staging(events)), "partial_max"),
        (stations.station_utilisation(feeds.trip_moves(lineitem)), "partial_sum"),
        (availability.station_fill(feeds.status_fact(events)), "partial_avg"),
    ):
        plan = planned(df)
        assert plan.count("Exchange") == 1
        assert partial in plan.split("Exchange")[1]


def test_rankings_need_no_global_sort(spark):
    for name in ("peak_hours", "busiest_stations"):
        plan = planned(QUERIES[name](spark, SF))
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_tiers_scan_the_trips_once(spark):
    utilisation = stations.station_utilisation(feeds.trip_moves(table(spark, SF, "lineitem")))
    final = final_plan(stations.utilisation_tier(utilisation))
    assert "ReusedExchange" in final  # the counts behind the percentiles
    assert "ReusedSubquery" in final  # one percentile query for both cuts


# -- hot keys ------------------------------------------------------------------

DAY = dt.date(2024, 5, 1)


def hot_trips(spark, rows_=200_000):
    """Trips of which a third start and end at one station, a ninth nowhere."""
    number = F.col("id")
    station = (
        F.when(number % 3 == 0, "7").when(number % 9 == 1, None).otherwise((number % 1000).cast("string"))
    )
    return spark.range(0, rows_, 1, 16).select(
        number.alias("trip_id"),
        F.lit(DAY).alias("day"),
        station.alias("start_station"),
        station.alias("end_station"),
        F.repeat(F.sha2(number.cast("string"), 256), 2).alias("note"),
    )


def dimension(spark):
    return spark.range(1000).select(
        *[
            F.col("id").cast("string").alias("station_id") if f.name == "station_id"
            else F.lit(dt.date(2024, 1, 1)).alias(f.name) if f.name == "start_date"
            else F.lit("s").alias(f.name) if f.dataType.simpleString() == "string"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in DIM_STATIONS
        ]
    )


@pytest.fixture
def large_tables(conf):
    """Make the test's tables count as too large to broadcast and as skewed."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="256KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="512KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )


def test_as_of_splits_a_hot_station(spark, large_tables):
    fact = hot_trips(spark).withColumnRenamed("start_station", "station_id")
    got = scd.scd_as_of(fact, dimension(spark), "day", broadcast_bytes=0)
    assert "skew=true" in final_plan(got)
    assert got.count() == 200_000
    assert got.filter("station_id = '7'").filter("name = 's'").count() == got.filter("station_id = '7'").count()


def test_star_join_splits_a_hot_station(spark, large_tables):
    names = dimension(spark).select("station_id", "name")
    got = trips.trips_with_stations(hot_trips(spark), names, broadcast_bytes=0)
    assert final_plan(got).count("skew=true") >= 2
    assert got.count() == 200_000


def test_both_join_forms_agree(spark, large_tables):
    fact = hot_trips(spark, 5_000)
    stations_ = dimension(spark).select("station_id", "name")
    small = trips.trips_with_stations(fact, stations_)
    large = trips.trips_with_stations(fact, stations_, broadcast_bytes=0)
    assert "BroadcastHashJoin" in planned(small) and "SortMergeJoin" in planned(large)
    assert rows(small) == rows(large)


def test_broadcast_needs_a_measured_size(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert sizing.measured(df) == (100, 10 * 1 + 90 * 2)
    assert sizing.measured(df.filter("false")) == (0, 0)
    hinted = sizing.broadcast_if_small(df)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower()
    for limits in ({"max_bytes": 100}, {"max_rows": 99}):
        plain = sizing.broadcast_if_small(df, **limits)._jdf.queryExecution().logical().toString()
        assert "broadcast" not in plain.lower()


def test_hot_folder_is_split_when_written(spark, conf):
    from velotide.sources import files
    from velotide.sources.tables import load

    conf(adaptive__advisoryPartitionSizeInBytes="256KB")
    path = files.scratch_dir(spark, "hot")
    folder = F.when(F.col("start_station") == "7", "hot").otherwise("rest")
    load(hot_trips(spark).withColumn("p", folder), path, partition_by=["p"])
    hot = spark.read.parquet(path).filter("p = 'hot'")
    assert hot.select(F.input_file_name()).distinct().count() > 1
    assert spark.read.parquet(path).count() == 200_000


@pytest.mark.parametrize("size, partitions", [(100 * 1024**4, 3_276_801), (1024**4, 32_769), (1, 8)])
def test_shuffles_are_sized_by_the_input(spark, monkeypatch, size, partitions):
    monkeypatch.setattr(session.files, "total_bytes", lambda spark, path: size)
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    with pytest.raises(KeyError), session.sized_shuffles(spark, "anything") as n:
        assert n == partitions
        assert spark.conf.get(session.INITIAL_PARTITIONS) == str(partitions)
        raise KeyError
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) == before


def test_daily_jobs_size_their_shuffles(spark, monkeypatch):
    """While they write, and not after."""
    seen = []
    write = tables.write_partitioned

    def spy(df, *rest):
        seen.append(spark.conf.get(session.INITIAL_PARTITIONS, None))
        write(df, *rest)

    for module in (tables, merge):
        monkeypatch.setattr(module, "write_partitioned", spy)
    monkeypatch.setattr(session.files, "total_bytes", lambda spark, path: 1024**4)
    base = files.scratch_dir(spark, "sized")
    header = ",".join(c.split()[0] for c in schemas.TRIP_CSV.split(","))
    line = "1,7,2024-01-02T08:05:00,2024-01-02T08:12:00,1,2,b1,30,Round Trip,Month,standard"
    spark.createDataFrame([(f"{header}\n{line}",)], "value string").coalesce(1).write.text(f"{base}/csv")
    warehouse.load_trips(spark, f"{base}/csv", base)
    staged = spark.createDataFrame([], schemas.STATUS_TABLE).drop("utc_date")
    staged.write.parquet(f"{base}/{warehouse.STATUS_STAGING}/utc_date=2024-01-30/query=q/batch=0")
    warehouse.load_status(spark, base, "2024-01-30")
    assert seen == ["32769", "32769"]
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
