import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from velotide.sources import feeds, files, snapshots, tables, versions

# -- station info --------------------------------------------------------------


def station(number, **changes):
    return {
        "station_id": f"net_{number}",
        "name": "A",
        "lon": -75.1,
        "lat": 39.9,
        "_bcycle_station_type": "dock",
        "address": "1 Main St",
        **changes,
    }


def write_texts(spark, *texts):
    path = files.scratch_dir(spark, "texts")
    for n, text in enumerate(texts):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{n}")
    return f"{path}/*"


def test_station_documents_over_several_lines(spark):
    document = json.dumps({"data": {"stations": [station(3010), station(12)]}}, indent=2)
    other = json.dumps({"data": {"stations": [station(7777)]}})
    got = feeds.station_rows(feeds.read_station_info(spark, write_texts(spark, document, other)))
    assert got.columns == ["station_id", "name", "lon", "lat", "station_type", "address", "active_status"]
    assert rows(got) == [
        (key, "A", -75.1, 39.9, "dock", "1 Main St", True) for key in ("3010", "7777", "t_12")
    ]


def test_incomplete_stations_are_rejected(spark):
    lacking = station(2)
    del lacking["address"]
    document = json.dumps({"data": {"stations": [station(3010), lacking, station(4, lat=None), None]}})
    entries = feeds.station_entries(spark.createDataFrame([(document,)], "value string"))
    assert feeds.station_rows(entries).count() == 1
    assert rows(feeds.station_rejects(entries), "station_id") == [("net_2",), ("net_4",), (None,)]


# -- weather -------------------------------------------------------------------

REPORT = """start bigint, end bigint, interval_s int, temperature_2m array<float>,
    relative_humidity_2m array<float>, rain array<float>, snowfall array<float>,
    cloud_cover array<float>"""
MIDNIGHT = 1735707600  # 2025-01-01 05:00Z


def report(spark, n, end=None, **series):
    values = [
        series.get(c, [1.0] * n)
        for c in ("temperature_2m", "relative_humidity_2m", "rain", "snowfall", "cloud_cover")
    ]
    end = MIDNIGHT + 3600 * n if end is None else end
    return spark.createDataFrame([(MIDNIGHT, end, 3600, *values)], REPORT)


def test_weather_axis_is_half_open(spark):
    got = feeds.weather_rows(report(spark, 24, temperature_2m=[float(i) for i in range(24)])).collect()
    assert [r["temperature_2m"] for r in got] == [float(i) for i in range(24)]
    assert (got[0]["date"], got[-1]["date"]) == ("2025-01-01T05:00:00+00:00", "2025-01-02T04:00:00+00:00")


def test_weather_end_between_steps(spark):
    assert feeds.weather_rows(report(spark, 3, end=MIDNIGHT + 2 * 3600 + 1)).count() == 3


def test_weather_numbers(spark):
    got = feeds.weather_rows(
        report(
            spark,
            2,
            temperature_2m=[3.1, None],
            relative_humidity_2m=[66.9, float("nan")],
            cloud_cover=[-0.9, None],
        )
    ).collect()
    assert got[0]["temperature_2m"] == pytest.approx(3.0999999046, abs=1e-10)
    assert [(r["relative_humidity_2m"], r["cloud_cover"]) for r in got] == [(66, 0), (None, None)]


def test_weather_empty_interval(spark):
    assert feeds.weather_rows(report(spark, 0, end=MIDNIGHT)).count() == 0


@pytest.mark.parametrize("rain", [[1.0] * 23, [1.0] * 25, None])
def test_weather_arrays_must_fit(spark, rain):
    with pytest.raises(PySparkException, match="do not fit the time axis"):
        feeds.weather_rows(report(spark, 24, rain=rain)).collect()


# -- trips ---------------------------------------------------------------------

HEADER = (
    "trip_id,duration,start_time,end_time,start_station,end_station,bike_id,plan_duration,"
    "trip_route_category,passholder_type,bike_type"
)
LINE = "{0},7,1/2/2024 8:05,1/2/2024 8:12,3010,3032,b1,30,One Way,Month,standard"


def test_trips_of_several_quarters(spark):
    path = write_texts(spark, f"{HEADER}\n{LINE.format(1)}\n{LINE.format(2)}", f"{HEADER}\n{LINE.format(3)}")
    got = feeds.read_trips(spark, path, timestamp_format="M/d/yyyy H:mm")
    assert rows(got, "trip_id", "start_time", "bike_type") == [
        (str(n), dt.datetime(2024, 1, 2, 8, 5), "standard") for n in (1, 2, 3)
    ]


def test_trips_with_another_header_fail(spark):
    path = write_texts(spark, HEADER.replace("trip_id", "id") + "\n" + LINE.format(1))
    with pytest.raises(Exception, match="header does not conform"):
        feeds.read_trips(spark, path, timestamp_format="M/d/yyyy H:mm").collect()


def test_malformed_trips_fail_or_are_dropped(spark):
    path = write_texts(spark, f"{HEADER}\n{LINE.format(1)}\n{LINE.format(2).replace(',7,', ',seven,')}")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        feeds.read_trips(spark, path, timestamp_format="M/d/yyyy H:mm").collect()
    kept = feeds.read_trips(spark, path, mode="DROPMALFORMED", timestamp_format="M/d/yyyy H:mm")
    assert [row[0] for row in rows(kept)] == ["1"]  # whole rows are read


# -- loads ---------------------------------------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def stored(spark, path):
    return sorted(r["v"] for r in versions.read(spark, path).collect())


def test_dispositions(spark):
    path = files.scratch_dir(spark, "load")
    tables.load(numbers(spark, 1), path, tables.EMPTY)
    with pytest.raises(tables.TableNotEmptyError):
        tables.load(numbers(spark, 9), path, tables.EMPTY)
    tables.load(numbers(spark, 2), path, tables.APPEND)
    assert stored(spark, path) == [1, 2]
    tables.load(numbers(spark, 3), path)
    assert stored(spark, path) == [3]
    tables.load(numbers(spark), path, tables.TRUNCATE)
    tables.load(numbers(spark, 4), path, tables.EMPTY)
    assert stored(spark, path) == [4]
    with pytest.raises(ValueError):
        tables.load(numbers(spark, 1), path, "WRITE_SOMEHOW")


def test_append_run_again_adds_nothing(spark):
    path = files.scratch_dir(spark, "load")
    for load_id, value in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 2)):
        tables.load(numbers(spark, value), path, tables.APPEND, load_id=load_id)
    assert stored(spark, path) == [1, 2]


def test_a_failing_load_raises(spark):
    bad = numbers(spark, 1).select((F.col("v") / 0).alias("v"))
    with pytest.raises(PySparkException):
        tables.load(bad, files.scratch_dir(spark, "load"))


@pytest.mark.parametrize("replace", [tables.load, tables.rebuild])
def test_a_load_that_fails_half_way_leaves_the_old_rows(spark, replace):
    path = files.scratch_dir(spark, "load")
    tables.load(numbers(spark, 1, 2, 3), path)
    late = spark.range(1000, numPartitions=4).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("int")).alias("v")
    )
    for _ in range(2):
        with pytest.raises(PySparkException):
            replace(late, path)
        assert stored(spark, path) == [1, 2, 3]
    replace(numbers(spark, 4), path)
    assert stored(spark, path) == [4]


def test_replaced_states_are_dropped_but_the_last(spark):
    path = files.scratch_dir(spark, "load")
    for n in range(5):
        tables.load(numbers(spark, n), path)
    assert stored(spark, path) == [4]
    assert len(files.subdirectories(spark, path)) == 2


def test_unread_table(spark):
    with pytest.raises(FileNotFoundError):
        versions.read(spark, files.scratch_dir(spark, "load"))


def test_partitioned_load_holds_all_rows(spark):
    path = files.scratch_dir(spark, "load")
    df = spark.range(1000).select(F.col("id").alias("v"), F.when(F.col("id") < 900, 1).otherwise(2).alias("p"))
    tables.load(df, path, partition_by=["p"])
    assert files.subdirectories(spark, versions.current(spark, path)) == ["p=1", "p=2"]
    assert stored(spark, path) == list(range(1000))


def test_schema_hints(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "date int, extra string, rain double")
    assert [f.simpleString() for f in tables.apply_schema_hints(df, "weather").schema] == [
        "date:string", "extra:string", "rain:double",
    ]
    assert tables.table_name("stations_info") == "stg_stations"
    with pytest.raises(KeyError, match="unheard"):
        tables.apply_schema_hints(df, "unheard")
    with pytest.raises(ValueError, match="station_id"):
        tables.apply_schema_hints(df, "stations_info")


def test_rebuild_replaces(spark):
    path = files.scratch_dir(spark, "rebuild")
    tables.rebuild(numbers(spark, 1, 2), path)
    assert rows(tables.rebuild(numbers(spark, 3), path)) == [(3,)]


# -- snapshots -----------------------------------------------------------------


def test_snapshot_is_written_once(spark):
    base = files.scratch_dir(spark, "snapshots")
    assert snapshots.snapshot_csv(numbers(spark, 1), base, "2024-01-30")
    assert not snapshots.snapshot_csv(numbers(spark, 2), base, "2024-01-30")
    assert snapshots.snapshot_csv(numbers(spark, 3), base, dt.date(2024, 1, 31))
    assert rows(spark.read.csv(f"{base}/stations_info_2024-01-30", header=True)) == [("1",)]


def test_a_broken_snapshot_is_written_again(spark):
    base = files.scratch_dir(spark, "snapshots")
    snapshots.snapshot_csv(numbers(spark, 1), base, "2024-01-30")
    files.delete(spark, f"{base}/stations_info_2024-01-30/_SUCCESS")
    assert snapshots.snapshot_csv(numbers(spark, 2), base, "2024-01-30")
    assert rows(spark.read.csv(f"{base}/stations_info_2024-01-30", header=True)) == [("2",)]


def test_expiry_at_seven_days(spark):
    base = files.scratch_dir(spark, "snapshots")
    for day in (22, 23, 24, 30):
        snapshots.snapshot_csv(numbers(spark, day), base, f"2024-01-{day}")
    tables.load(numbers(spark, 0), f"{base}/other")
    assert snapshots.expire(spark, base, "2024-01-30") == [
        "stations_info_2024-01-22", "stations_info_2024-01-23",
    ]
    assert files.subdirectories(spark, base) == [
        "other", "stations_info_2024-01-24", "stations_info_2024-01-30",
    ]


# -- scratch folders -----------------------------------------------------------


class FakeSession:
    """As much of a session as scratch_dir asks for."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_scratch_lies_in_the_shared_folder():
    session = FakeSession("spark://host:7077", "hdfs://nn/shared/")
    first, second = files.scratch_dir(session, "x"), files.scratch_dir(session, "x")
    assert first.startswith("hdfs://nn/shared/velotide/x-") and first != second


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files.scratch_dir(FakeSession("spark://host:7077"), "x")


def test_a_local_session_gets_one_folder_of_its_own():
    session = FakeSession("local[2]")
    first, second = files.scratch_dir(session, "a"), files.scratch_dir(session, "b")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
