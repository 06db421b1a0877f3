"""The dimension from dated snapshots against merging them one after the other."""

import datetime as dt
import random

import pytest
from helpers import rows

from velotide.operators import history, scd
from velotide.schemas import DIM_STATIONS
from velotide.sources import snapshots, versions

D = dt.date
STATION = "station_id string, name string, lon double, lat double, station_type string, address string, active_status boolean"


def random_day(rng, stations=12):
    """A snapshot: stations that come and go, unknown values and statuses."""
    out = []
    for i in range(stations):
        if rng.random() < 0.6:
            name = rng.choice([None, f"n{rng.randrange(100)}"])
            status = rng.choice([True, True, True, False, None])
            out.append((f"s{i}", name, rng.choice([1.0, None]), 2.0, "dock", f"a{rng.randrange(100)}", status))
    return out


def days_of(seed, n=8):
    rng = random.Random(seed)
    days = sorted(rng.sample(range(1, 29), n))
    return {D(2024, 5, d): random_day(rng, 12 if k % 3 else 0) for k, d in enumerate(days)}


def merged(spark, days, start=()):
    dim = spark.createDataFrame(list(start), DIM_STATIONS)
    for day in sorted(days):
        after = scd.scd2_merge(dim, spark.createDataFrame(days[day], STATION), day, f"{day} 06:00:00")
        dim = spark.createDataFrame(after.collect(), DIM_STATIONS)
    return dim


def listed(spark, days):
    found = [(day, *s) for day, stations in days.items() for s in stations]
    return spark.createDataFrame(found, f"{history.DAY} date, {STATION}").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_equals_merging_day_by_day(spark, seed):
    days = days_of(seed)
    got = history.versions_of(listed(spark, days), {d: f"{d} 06:00:00" for d in days})
    assert rows(got) == rows(merged(spark, days))


def test_goes_on_from_open_versions(spark):
    then = dt.datetime(2024, 1, 1)
    start = [
        ("s0", "old", 1.0, 2.0, "dock", "x", True, D(2024, 1, 1), None, then),
        ("s1", "old", 1.0, 2.0, "dock", "x", False, D(2024, 1, 1), None, then),
        ("s2", "old", 1.0, 2.0, "dock", "x", None, D(2024, 1, 1), None, then),
        ("s3", "old", 1.0, 2.0, "dock", "x", True, None, None, then),
        ("gone", "old", 1.0, 2.0, "dock", "x", True, D(2024, 1, 1), None, then),
    ]
    for seed in range(2):
        days = days_of(10 + seed, 4)
        opened = spark.createDataFrame(start, DIM_STATIONS)
        got = history.versions_of(listed(spark, days), {d: f"{d} 06:00:00" for d in days}, opened)
        assert rows(got) == rows(merged(spark, days, start))


def test_no_days_and_empty_snapshots(spark):
    none = listed(spark, {})
    assert history.versions_of(none, {}).collect() == []
    assert history.versions_of(none, {D(2024, 5, 1): "2024-05-01 06:00:00"}).collect() == []
    one = {D(2024, 5, 1): [("s", "n", 1.0, 2.0, "dock", "a", True)], D(2024, 5, 3): []}
    got = history.versions_of(listed(spark, one), {d: f"{d} 06:00:00" for d in one})
    assert rows(got, "active_status", "start_date", "end_date") == [
        (False, D(2024, 5, 3), None), (True, D(2024, 5, 1), D(2024, 5, 3))
    ]


def stored(spark, tmp_path, days, late):
    """Days merged in order but for the late ones, which are put in afterwards."""
    path, base = str(tmp_path / "dim"), str(tmp_path / "snapshots")
    for day in sorted(days, key=lambda d: (d in late, d)):
        snapshot = spark.createDataFrame(days[day], STATION)
        if day in late:
            snapshots.snapshot_csv(snapshot, base, day)
            history.put_in_late(spark, path, base, day, f"{day} 06:00:00")
        else:
            scd.apply_snapshot(snapshot, path, day, f"{day} 06:00:00")
            snapshots.snapshot_csv(snapshot, base, day)
    return path, base


STORED = ["station_id", "name", "address", "active_status", "start_date", "end_date"]


@pytest.mark.parametrize("seed, at", [(20, [3]), (21, [1, 5]), (22, [4, 2])])
def test_late_days_give_the_dimension_of_all(spark, tmp_path, seed, at):
    days = days_of(seed, 7)
    order = sorted(days)
    late = [order[k] for k in at]
    path, base = stored(spark, tmp_path, days, late)
    want = rows(merged(spark, days), *STORED)
    assert rows(scd.read_stations(spark, path), *STORED) == want
    # Again, it changes nothing; and the last day can be run again, or go on.
    history.put_in_late(spark, path, base, late[0], f"{late[0]} 06:00:00")
    assert rows(scd.read_stations(spark, path), *STORED) == want
    other = {**days, order[-1]: random_day(random.Random(seed + 50))}
    scd.apply_snapshot(spark.createDataFrame(other[order[-1]], STATION), path, order[-1], f"{order[-1]} 06:00:00")
    assert rows(scd.read_stations(spark, path), *STORED) == rows(merged(spark, other), *STORED)
    more = {**other, D(2024, 6, 1): random_day(random.Random(seed + 51))}
    scd.apply_snapshot(spark.createDataFrame(more[D(2024, 6, 1)], STATION), path, "2024-06-01", "2024-06-01 06:00:00")
    assert rows(scd.read_stations(spark, path), *STORED) == rows(merged(spark, more), *STORED)


def test_only_the_stations_that_change_are_derived_again(spark, tmp_path):
    station = ("n", 1.0, 2.0, "dock", "a", True)
    days = {D(2024, 5, k): [(f"s{i}", *station) for i in range(20) if (i, k) != (3, 2)] for k in (1, 2, 3)}
    path, _ = stored(spark, tmp_path, days, [D(2024, 5, 2)])
    dim = scd.read_stations(spark, path)
    assert rows(dim.where("station_id = 's3'"), "active_status", "start_date", "end_date") == [
        (False, D(2024, 5, 2), D(2024, 5, 3)), (True, D(2024, 5, 1), D(2024, 5, 2)), (True, D(2024, 5, 3), None)
    ]
    assert {r["last_updated"].day for r in dim.where("station_id != 's3'").collect()} == {3}
    again = spark.createDataFrame(days[D(2024, 5, 1)][5:], STATION)  # s0 to s4 are missing
    found = rows(history.affected(dim, again, D(2024, 5, 2)))
    assert found == [("s0",), ("s1",), ("s2",), ("s4",)]  # s3 was inactive anyway


def test_a_day_whose_followers_are_not_kept_is_refused(spark, tmp_path):
    days = days_of(30, 5)
    order = sorted(days)
    path, base = stored(spark, tmp_path, days, [])
    snapshots.expire(spark, base, order[3], days=0)
    with pytest.raises(FileNotFoundError):
        history.put_in_late(spark, path, base, "2024-04-01", "2024-04-01 06:00:00")
    day = order[2]
    snapshots.snapshot_csv(spark.createDataFrame(days[day], STATION), base, day)
    before = versions.state(spark, path)
    with pytest.raises(scd.LateRunError):
        history.put_in_late(spark, path, base, day, f"{day} 06:00:00")
    assert versions.state(spark, path) == before
