"""The daily jobs over several days."""

import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from velotide.__main__ import run
from velotide.operators.dedup import DuplicateKeyError
from velotide.operators.merge import status_new_rows
from velotide.plans import warehouse
from velotide.registry import QUERIES
from velotide.sources import files, tables
from velotide.sources.feeds import StationDocumentError
from velotide.streaming import ingest


def documents(spark, base, day, *numbers):
    text = json.dumps(
        {"data": {"stations": [
            {"station_id": f"net_{n}", "name": f"S{n}", "lon": 1.0, "lat": 2.0,
             "_bcycle_station_type": "dock", "address": "x"} for n in numbers]}},
        indent=1,
    )
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/info/{day}")
    return f"{base}/info/{day}"


def test_stations_over_three_days(spark):
    base = files.scratch_dir(spark, "warehouse")
    for day, numbers in (("2024-01-01", (3010, 3032)), ("2024-01-02", (3010,)), ("2024-01-03", (3010, 3032))):
        path = documents(spark, base, day, *numbers)
        for _ in range(2):  # every job may be run again
            warehouse.load_stations(spark, path, base, day, f"{day} 06:00:00")
    got = warehouse.read_dimension(spark, base)
    closed = got.filter("station_id = '3032'")
    assert rows(closed.select("active_status", F.day("start_date"), F.day("end_date"))) == [
        (False, 2, 3), (True, 1, 2), (True, 3, None),
    ]
    assert got.filter("station_id = '3010'").count() == 1
    assert tables.read_table(spark, base, "stations_info").count() == 2
    assert files.subdirectories(spark, f"{base}/snapshots") == [
        "stations_info_2024-01-01", "stations_info_2024-01-02", "stations_info_2024-01-03",
    ]


def broken_documents(spark, base, kind):
    good = {"station_id": "net_3010", "name": "S", "lon": 1.0, "lat": 2.0, "_bcycle_station_type": "dock"}
    text = {
        "garbage": "<html>502 Bad Gateway</html>",
        "cut off": '{"data": {"stations": [{"station_id": "net_3010",',
        "no list": '{"data": {}}',
        "missing field": json.dumps({"data": {"stations": [good]}}),
        "twice": json.dumps({"data": {"stations": [{**good, "address": "x"}] * 2}}),
    }[kind]
    path = f"{base}/info/broken"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("kind", ["garbage", "cut off", "no list", "missing field", "twice"])
def test_a_broken_station_day_changes_nothing_and_can_be_run_again(spark, kind):
    base = files.scratch_dir(spark, "warehouse")
    warehouse.load_stations(
        spark, documents(spark, base, "2024-01-01", 3010, 3032), base, "2024-01-01", "2024-01-01 06:00:00"
    )
    before = rows(warehouse.read_dimension(spark, base))
    with pytest.raises((StationDocumentError, DuplicateKeyError)):
        warehouse.load_stations(
            spark, broken_documents(spark, base, kind), base, "2024-01-02", "2024-01-02 06:00:00"
        )
    assert rows(warehouse.read_dimension(spark, base)) == before
    assert tables.read_table(spark, base, "stations_info").count() == 2
    assert files.subdirectories(spark, f"{base}/snapshots") == ["stations_info_2024-01-01"]

    good = documents(spark, base, "2024-01-02", 3010)
    warehouse.load_stations(spark, good, base, "2024-01-02", "2024-01-02 07:00:00")
    got = warehouse.read_dimension(spark, base).filter("end_date IS NULL")
    assert rows(got, "station_id", "active_status") == [("3010", True), ("3032", False)]
    assert rows(tables.read_table(spark, base, "stations_info"), "station_id") == [("3010",)]
    snapshot = spark.read.option("header", True).csv(f"{base}/snapshots/stations_info_2024-01-02")
    assert rows(snapshot, "station_id") == [("3010",)]


def test_no_document_is_no_snapshot(spark):
    base = files.scratch_dir(spark, "warehouse")
    spark.createDataFrame([], "value string").write.text(f"{base}/info")
    with pytest.raises(StationDocumentError):
        warehouse.load_stations(spark, f"{base}/info", base, "2024-01-02", "2024-01-02 06:00:00")


def test_the_first_status_load_has_no_window(spark):
    base = files.scratch_dir(spark, "warehouse")
    first = 1735689600  # 2025-01-01
    texts = [
        (json.dumps({"data": {"stations": [{"station_id": "hub_1", "last_reported": first - d * 86400}]}}),)
        for d in (0, 1, 200, 900)
    ]
    spark.createDataFrame(texts, "value string").write.parquet(f"{base}/in")
    stream = spark.readStream.schema("value string").parquet(f"{base}/in")
    ingest.append_status(stream, f"{base}/stations_status", f"{base}/checkpoint").awaitTermination()
    run(spark, ["status", "--base", base, "--run-date", "2025-01-01", "--backfill"])
    assert warehouse.read_status(spark, base).count() == 4
    run(spark, ["status", "--base", base, "--run-date", "2025-01-01"])
    assert warehouse.read_status(spark, base).count() == 4


def test_weather_day_run_again(spark):
    base = files.scratch_dir(spark, "warehouse")
    start = 1735707600
    for day in (0, 1, 1):
        reports = spark.createDataFrame(
            [(start + day * 86400, start + (day + 1) * 86400, 3600, *[[float(day)] * 24] * 5)],
            """start bigint, end bigint, interval_s int, temperature_2m array<float>,
               relative_humidity_2m array<float>, rain array<float>, snowfall array<float>,
               cloud_cover array<float>""",
        )
        warehouse.load_weather(reports, base, f"2025-01-0{day + 1}")
    got = warehouse.read_weather(spark, base)
    series = ["temperature_2m", "relative_humidity_2m", "rain", "snowfall", "cloud_cover"]
    assert got.columns == ["date", *series, "load_id"]
    assert got.dtypes[0] == ("date", "string")
    assert got.count() == 48 == got.select("date").distinct().count()


def test_status_jobs_read_only_the_days_of_the_window(spark):
    base = files.scratch_dir(spark, "warehouse")
    first = 1735689600  # 2025-01-01
    texts = [
        (json.dumps({"data": {"stations": [{"station_id": "hub_1", "last_reported": first + d * 86400 + 43200}]}}),)
        for d in range(10)
    ]
    source = f"{base}/in"
    spark.createDataFrame(texts, "value string").write.parquet(source)
    stream = spark.readStream.schema("value string").parquet(source)
    ingest.append_status(stream, f"{base}/stations_status", f"{base}/checkpoint").awaitTermination()

    for run_date in ("2025-01-05", "2025-01-06", "2025-01-06"):
        warehouse.load_status(spark, base, run_date)
    assert rows(warehouse.read_status(spark, base).select(F.day("est_date"))) == [(4,), (5,), (6,)]

    staging = ingest.read_status_table(spark, f"{base}/stations_status")
    new = status_new_rows(warehouse.read_status(spark, base), staging, "2025-01-07")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(") == 2  # utc_date and est_date
    assert new.count() == 1


def test_commands(spark):
    base = files.scratch_dir(spark, "warehouse")
    path = documents(spark, base, "2024-01-01", 3010)
    run(spark, ["stations", "--base", base, "--run-date", "2024-01-01", "--documents", path])
    assert rows(warehouse.read_dimension(spark, base), "station_id") == [("3010",)]

    header = (
        "trip_id,duration,start_time,end_time,start_station,end_station,bike_id,plan_duration,"
        "trip_route_category,passholder_type,bike_type"
    )
    line = "1,7,1/2/2024 8:05,1/2/2024 8:12,3010,3010,b1,30,Round Trip,Month,standard"
    csv = f"{base}/csv"
    spark.createDataFrame([(f"{header}\n{line}",)], "value string").coalesce(1).write.text(csv)
    run(spark, ["trips", "--base", base, "--files", csv, "--timestamp-format", "M/d/yyyy H:mm"])
    assert rows(warehouse.read_trip_fact(spark, base), "trip_id", "is_round_trip", "bike_type") == [
        (1, True, "classic")
    ]

    run(spark, ["status", "--base", base, "--run-date", "2024-01-01"])  # nothing streamed yet
    run(spark, ["compact", "--base", base, "--before", "2024-01-01"])
    assert warehouse.read_status(spark, base).count() == 0
    for job in ("land", "stream"):
        with pytest.raises(Exception, match="kafka"):
            run(spark, [job, "--base", base, "--servers", "host:9092", "--topic", "t"])
    with pytest.raises(SystemExit):
        run(spark, ["status", "--base", base])


def test_endless_jobs_start_their_sink(spark, monkeypatch):
    """With a file stream in place of the topic, and one pass in place of no end."""
    base = files.scratch_dir(spark, "warehouse")
    text = '{"data": {"stations": [{"station_id": "hub_1", "last_reported": 1735689600}]}}'
    spark.createDataFrame([(text.encode(),)], "value binary").withColumn(
        "ingest_ts", F.current_timestamp()
    ).write.parquet(f"{base}/topic")
    stream = spark.readStream.schema("value binary, ingest_ts timestamp").parquet(f"{base}/topic")
    monkeypatch.setattr(ingest, "read_status_stream", lambda *_: stream)
    for name in ("land_raw", "append_status"):
        sink = getattr(ingest, name)
        monkeypatch.setattr(ingest, name, lambda p, path, check, _, sink=sink: sink(p, path, check))
    arguments = ["--base", base, "--servers", "host:9092", "--topic", "t"]
    run(spark, ["land", *arguments])
    run(spark, ["stream", *arguments])
    assert spark.read.parquet(f"{base}/{warehouse.STATUS_RAW}").count() == 1
    staged = ingest.read_status_table(spark, f"{base}/{warehouse.STATUS_STAGING}")
    assert rows(staged, "station_id") == [("1",)]


def test_stations_whose_ids_end_alike(spark):
    base = files.scratch_dir(spark, "warehouse")
    path = documents(spark, base, "2024-01-01", 1090, 11090)
    with pytest.raises(DuplicateKeyError, match="1090"):
        warehouse.load_stations(spark, path, base, "2024-01-01", "2024-01-01 06:00:00")
    warehouse.load_stations(spark, path, base, "2024-01-01", "2024-01-01 06:00:00", key_length=9)
    assert rows(warehouse.read_dimension(spark, base), "station_id") == [("net_1090",), ("net_11090",)]


def test_a_day_of_stations_with_long_ids(spark, tmp_path):
    # Of the last two, all but the sign is alike.
    ids = [7, 1090, 11090, 2**63 - 1, -(2**63 - 1)]
    moment = dt.datetime(2024, 1, 15, 3)
    tables_ = {
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"S{i}", 1, 1.0) for i in ids]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
                   [(n, moment, i, "view", 10.0) for n, i in enumerate((1090, 11090, 11090))]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string",
                   [(n, i, "F", 50000.0, moment, "2-HIGH") for n, i in enumerate((1090, 11089, 11090))]),
    }
    for name, (schema, values) in tables_.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(QUERIES["warehouse_day"](spark, str(tmp_path))) == sorted([
        ("7", "S7", None, None, None), ("1090", "S1090", 1, 0.2, 1), ("11090", "S11090", 1, 0.2, 2),
        *[(str(i), f"S{i}", None, None, None) for i in ids[-2:]],
    ], key=repr)
