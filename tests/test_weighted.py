"""Availability weighted by time, and lookups without a join."""

import datetime as dt
import random

import pytest
from helpers import final_plan, rows

from velotide.operators import scd
from velotide.plans import availability
from velotide.schemas import DIM_STATIONS

FACT = "station_id string, utc_timestamp timestamp, num_bikes_available int, num_docks_available int"
START = dt.datetime(2025, 1, 6, 5)  # midnight in New York


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def fact(spark, *readings):
    """Readings (station, seconds, bikes, docks) with their local time."""
    df = spark.createDataFrame([(s, at(t), b, d) for s, t, b, d in readings], FACT)
    return df.selectExpr("*", "cast(from_utc_timestamp(utc_timestamp, 'America/New_York') as timestamp_ntz) AS est_datetime")


def test_each_reading_counts_until_the_next(spark):
    df = fact(spark, ("a", 0, 10, 0), ("a", 900, 0, 10), ("a", 3600 + 1800, 4, 6), ("a", 7200, 9, 9), ("b", 0, 2, 2), ("b", 1, 4, 0))
    assert rows(availability.weighted_station_fill(df)) == [
        ("a", 7200, (900 * 1.0 + 0 + 1800 * 0.4) / 7200, 4500 / 7200, 900 / 7200),
        ("b", 1, 0.5, 0.0, 0.0),
    ]
    got = {r["hour"]: (r["seconds"], r["avg_bikes"]) for r in availability.weighted_availability_by_hour(df).collect()}
    assert got == {0: (3601, (900 * 10 + 2) / 3601), 1: (3600, (1800 * 0 + 1800 * 4) / 3600)}


def test_the_last_reading_holds_until_a_given_time(spark):
    df = fact(spark, ("a", 0, 10, 0), ("a", 3600, 0, 10), ("a", 9000, 1, 1))
    fill = availability.weighted_station_fill(df, until=at(7200))
    assert rows(fill) == [("a", 7200, 0.5, 0.5, 0.5)]
    assert rows(availability.weighted_station_fill(df), "seconds") == [(9000,)]


def test_equals_the_mean_on_an_even_grid(spark):
    rng = random.Random(3)
    readings = [(s, t * 600, rng.randrange(20), rng.randrange(20)) for s in ("a", "b") for t in range(6 * 48)]
    readings = [(s, t, None if rng.random() < 0.1 else b, d) for s, t, b, d in readings]
    df = fact(spark, *readings)
    end = at(48 * 3600)
    mean = {r["hour"]: tuple(r)[1:] for r in availability.availability_by_hour(df).collect()}
    weighted = {r["hour"]: (r["avg_bikes"], r["avg_docks"]) for r in availability.weighted_availability_by_hour(df, end).collect()}
    assert weighted.keys() == mean.keys()
    assert all(weighted[h] == pytest.approx(mean[h]) for h in mean)
    plain = {r["station_id"]: (r["fill_ratio"], r["empty_share"], r["full_share"]) for r in availability.station_fill(df).collect()}
    timed = {r["station_id"]: (r["fill_ratio"], r["empty_share"], r["full_share"])
             for r in availability.weighted_station_fill(df, end).collect()}
    assert all(timed[s] == pytest.approx(plain[s]) for s in plain)


def test_busy_reporters_do_not_count_more(spark):
    """A station reports every minute while full, and once an hour otherwise."""
    busy = [("a", t * 60, 0, 10) for t in range(60)] + [("a", 3600, 10, 0)]
    df = fact(spark, *busy)
    (row,) = availability.weighted_station_fill(df, until=at(7200)).collect()
    assert row["empty_share"] == 0.5


def test_unknown_counts_and_single_readings(spark):
    df = fact(spark, ("a", 0, None, 5), ("a", 60, None, None), ("a", 120, 1, 1), ("b", 5, 1, 1))
    assert rows(availability.weighted_station_fill(df)) == [("a", 120, None, None, 0.0)]
    assert rows(availability.weighted_availability_by_hour(df)) == [(0, 120, None, 5.0)]
    assert availability.weighted_station_fill(df.limit(0)).collect() == []


def test_the_autumn_hour_counts_twice(spark):
    """01:00 to 02:00 passes twice on the day the clock goes back."""
    night = dt.datetime(2025, 11, 2, 5) - START  # 01:00 in summer time
    first = int(night.total_seconds())
    df = fact(spark, ("a", first, 3, 1), ("a", first + 2 * 3600, 0, 0))
    assert rows(availability.weighted_availability_by_hour(df)) == [(1, 7200, 3.0, 1.0)]


# -- the version valid on a day, without a join ----------------------------------

D = dt.date


def random_dim(rng, stations=6):
    out = []
    for i in range(stations):
        day = D(2024, 1, 1) + dt.timedelta(days=rng.randrange(60))
        while rng.random() < 0.85:
            end = day + dt.timedelta(days=rng.choice([1, 3, 40, 100]))
            last = rng.random() < 0.2
            out.append((f"s{i}", f"v{len(out)}", 1.0, 2.0, "dock", "a", rng.random() < 0.5, day, None if last else end, None))
            if last:
                break
            day = end + dt.timedelta(days=rng.choice([0, 0, 5]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sorted_lookup_equals_the_join(spark, seed):
    rng = random.Random(seed)
    dim = spark.createDataFrame(
        [*random_dim(rng), ("s9", "zero", 1.0, 2.0, "dock", "a", True, D(2024, 2, 1), D(2024, 2, 1), None),
         ("s8", "none", 1.0, 2.0, "dock", "a", True, None, None, None)],
        DIM_STATIONS,
    )
    facts = [(n, rng.choice([f"s{rng.randrange(10)}", None]), rng.choice([D(2023, 12, 1) + dt.timedelta(days=rng.randrange(400)), None]), "x")
             for n in range(300)]
    df = spark.createDataFrame(facts + facts[:3], "n int, station_id string, day date, name string")
    columns = ("active_status", "start_date", "address")
    got = scd.scd_as_of_sorted(df, dim, "day", columns=columns)
    assert rows(got) == rows(scd.scd_as_of(df, dim, "day", columns=columns))
    assert "Join" not in final_plan(got)


def test_sorted_lookup_of_nothing(spark):
    dim = spark.createDataFrame([], DIM_STATIONS)
    df = spark.createDataFrame([("a", D(2024, 1, 1))], "station_id string, day date")
    assert rows(scd.scd_as_of_sorted(df, dim, "day")) == [("a", D(2024, 1, 1), None, None, None)]
    assert scd.scd_as_of_sorted(df.limit(0), dim, "day").collect() == []


def test_very_many_versions_of_a_station(spark):
    """A station with 100,000 versions: rows don't multiply."""
    n = 100_000
    dim = spark.range(n).selectExpr(
        "'s' AS station_id", "concat('v', id) AS name", "1.0D AS lon", "2.0D AS lat", "'dock' AS station_type", "'a' AS address",
        "id % 2 = 0 AS active_status", "date_add(date'1800-01-01', int(id)) AS start_date",
        "date_add(date'1800-01-01', int(id) + 1) AS end_date", "timestamp'2024-01-01 00:00:00' AS last_updated",
    )
    facts = spark.range(20_000).selectExpr("'s' AS station_id", "date_add(date'1800-01-01', int(id * 5)) AS day", "id")
    got = scd.scd_as_of_sorted(facts, dim, "day", columns=("name",))
    assert got.count() == 20_000
    assert got.where("name != concat('v', id * 5)").isEmpty()
