import datetime as dt
import random

import pytest
from helpers import rows

from velotide.operators import scd
from velotide.operators.dedup import DuplicateKeyError
from velotide.schemas import DIM_STATIONS
from velotide.sources import files

SNAPSHOT = """station_id string, name string, lon double, lat double, station_type string,
    address string, active_status boolean"""
D = dt.date
DAY = [D(2024, 5, n) for n in range(1, 11)]


def snapshot(spark, *stations):
    """Stations (id, name), or (id, name, status)."""
    return spark.createDataFrame(
        [(s[0], s[1], 1.0, 2.0, "dock", "addr " + s[1], s[2] if len(s) > 2 else True) for s in stations],
        SNAPSHOT,
    )


def dim(spark, *versions):
    """Versions (id, name, active, start, end)."""
    then = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, n, 1.0, 2.0, "dock", "addr " + n, a, s, e, then) for i, n, a, s, e in versions],
        DIM_STATIONS,
    )


def versions(df):
    return rows(df, "station_id", "name", "active_status", "start_date", "end_date")


def run(dim_, snap, day, hour=6):
    return scd.scd2_merge(dim_, snap, day, f"{day} {hour:02d}:00:00")


@pytest.mark.parametrize(
    "before, listed, after",
    [
        # active, listed under a new name: only touched
        ([("1", "a", True, DAY[0], None)], [("1", "b")], [("1", "a", True, DAY[0], None)]),
        # active, not listed: closed, inactive version with the old attributes
        (
            [("1", "a", True, DAY[0], None)],
            [],
            [("1", "a", False, DAY[5], None), ("1", "a", True, DAY[0], DAY[5])],
        ),
        # inactive, not listed: touched
        ([("1", "a", False, DAY[0], None)], [], [("1", "a", False, DAY[0], None)]),
        # inactive, listed: closed, active version with the new attributes
        (
            [("1", "a", False, DAY[0], None)],
            [("1", "b")],
            [("1", "a", False, DAY[0], DAY[5]), ("1", "b", True, DAY[5], None)],
        ),
        # new
        ([], [("1", "a")], [("1", "a", True, DAY[5], None)]),
        # listed without a status counts as inactive
        (
            [("1", "a", True, DAY[0], None)],
            [("1", "b", None)],
            [("1", "a", True, DAY[0], DAY[5]), ("1", "b", False, DAY[5], None)],
        ),
        # an open version without status or start is closed and started anew
        (
            [("1", "a", None, DAY[0], None)],
            [("1", "b")],
            [("1", "a", None, DAY[0], DAY[5]), ("1", "b", True, DAY[5], None)],
        ),
        (
            [("1", "a", True, None, None)],
            [("1", "b")],
            [("1", "a", True, None, DAY[5]), ("1", "b", True, DAY[5], None)],
        ),
        # closed history stays
        ([("1", "a", True, DAY[0], DAY[1])], [], [("1", "a", True, DAY[0], DAY[1])]),
    ],
)
def test_cases(spark, before, listed, after):
    got = run(dim(spark, *before), snapshot(spark, *listed), DAY[5])
    assert versions(got) == sorted(after, key=repr)


def test_touch_moves_last_updated_of_open_versions_only(spark):
    before = dim(spark, ("1", "a", False, DAY[0], DAY[1]), ("1", "a", True, DAY[1], None))
    got = run(before, snapshot(spark, ("1", "a")), DAY[5])
    assert rows(got, "start_date", "last_updated") == [
        (DAY[0], dt.datetime(2024, 1, 1)),
        (DAY[1], dt.datetime(2024, 5, 6, 6)),
    ]


def test_reconcile_prefers_the_snapshot(spark):
    got = scd.scd_reconcile(
        dim(spark, ("1", "a", True, DAY[0], None), ("2", "c", True, DAY[0], None)),
        snapshot(spark, ("1", "b"), ("3", "d")),
    )
    assert rows(got, "station_id", "name", "active_status", "start_date") == [
        ("1", "b", True, DAY[0]), ("2", "c", False, DAY[0]), ("3", "d", True, None),
    ]


def test_same_day_flap_leaves_one_open_version(spark):
    d = run(dim(spark), snapshot(spark, ("1", "a")), DAY[0])
    d = run(d, snapshot(spark, ("1", "a")), DAY[5], 6)
    d = run(d, snapshot(spark), DAY[5], 7)
    d = run(d, snapshot(spark, ("1", "a")), DAY[5], 8)
    assert rows(scd.scd_current(d), "station_id", "active_status") == [("1", True)]


def test_merging_the_same_snapshot_again_only_touches(spark):
    snap = snapshot(spark, ("1", "a"), ("2", "b"), ("4", "d"))
    before = dim(
        spark,
        ("1", "a", False, DAY[0], None),
        ("2", "b", True, DAY[0], None),
        ("3", "c", True, DAY[0], None),
        ("4", "d", True, DAY[0], DAY[1]),
    )
    once = run(before, snap, DAY[5], 6)
    twice = run(once, snap, DAY[5], 7)
    assert versions(twice) == versions(once)
    touched = dt.datetime(2024, 5, 6, 7)
    assert rows(scd.scd_current(twice), "last_updated") == [(touched,)] * 4


def _model_merge(state, listed, day):
    """The merge rule station by station: state maps id -> [(active, start, end)]."""
    for station in set(state) | listed:
        history = state.setdefault(station, [])
        active = station in listed
        if history and history[-1][2] is None:
            if history[-1][0] == active:
                continue
            history[-1] = (*history[-1][:2], day)
        history.append((active, day, None))


@pytest.mark.parametrize("seed", range(3))
def test_random_histories(spark, seed):
    rng = random.Random(seed)
    path, state = files.scratch_dir(spark, "dim"), {}
    for n, day in enumerate(sorted(rng.choices(DAY, k=7))):
        listed = {str(s) for s in range(12) if rng.random() < 0.6}
        _model_merge(state, listed, day)
        if rng.random() < 0.4:  # first with another list, then again with the right one
            wrong = [(str(s), "w") for s in range(12) if rng.random() < 0.5]
            scd.apply_snapshot(snapshot(spark, *wrong), path, day, f"{day} {n + 1:02d}:00:00")
        scd.apply_snapshot(
            snapshot(spark, *[(s, "n" + s) for s in listed]), path, day, f"{day} {n + 1:02d}:00:00"
        )
        if n:
            with pytest.raises(scd.LateRunError):
                scd.apply_snapshot(snapshot(spark), path, day, f"{DAY[0]} 00:00:00")
    stored = scd.read_stations(spark, path)
    want = [(s, *v) for s, history in state.items() for v in history]
    assert rows(stored, "station_id", "active_status", "start_date", "end_date") == sorted(want, key=repr)
    for history in state.values():
        assert [v[2] for v in history[:-1]] == [v[1] for v in history[1:]]
        assert history[-1][2] is None


def test_running_a_run_again_changes_nothing(spark):
    path = files.scratch_dir(spark, "dim")
    scd.apply_snapshot(snapshot(spark, ("1", "a"), ("2", "b")), path, DAY[0], f"{DAY[0]} 06:00:00")
    for _ in range(2):
        scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[1], f"{DAY[1]} 06:00:00")
        assert versions(scd.read_stations(spark, path)) == [
            ("1", "a", True, DAY[0], None),
            ("2", "b", False, DAY[1], None),
            ("2", "b", True, DAY[0], DAY[1]),
        ]


def test_an_unfinished_run_is_not_read(spark, monkeypatch):
    path = files.scratch_dir(spark, "dim")
    scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[0], f"{DAY[0]} 06:00:00")
    scd.apply_snapshot(snapshot(spark), path, DAY[1], f"{DAY[1]} 06:00:00")
    # As if the third run had died before it moved the pointer.
    monkeypatch.setattr(scd.versions, "point", lambda *_: None)
    scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[2], f"{DAY[2]} 06:00:00")
    monkeypatch.undo()
    after_two = [("1", "a", False, DAY[1], None), ("1", "a", True, DAY[0], DAY[1])]
    assert versions(scd.read_stations(spark, path)) == after_two
    scd.apply_snapshot(snapshot(spark), path, DAY[3], f"{DAY[3]} 06:00:00")
    assert versions(scd.read_stations(spark, path)) == after_two


def test_a_late_run_is_refused(spark):
    path = files.scratch_dir(spark, "dim")
    for day, listed in ((DAY[0], [("1", "a")]), (DAY[2], [])):
        scd.apply_snapshot(snapshot(spark, *listed), path, day, f"{day} 06:00:00")
    before = versions(scd.read_stations(spark, path))
    with pytest.raises(scd.LateRunError):
        scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[1], f"{DAY[1]} 06:00:00")
    assert versions(scd.read_stations(spark, path)) == before


def test_run_times_are_instants(spark):
    path = files.scratch_dir(spark, "dim")
    scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[0], f"{DAY[0]}T06:00:00+00:00")
    # 05:00 in a zone two hours ahead is 03:00 UTC: late, though its text is not.
    with pytest.raises(scd.LateRunError):
        scd.apply_snapshot(snapshot(spark), path, DAY[0], f"{DAY[0]}T07:00:00+02:00")
    scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[0], f"{DAY[0]}T09:00:00+02:00")
    assert rows(scd.read_stations(spark, path), "last_updated") == [(dt.datetime(2024, 5, 1, 7),)]


def test_storage_does_not_grow_with_runs(spark, monkeypatch):
    monkeypatch.setattr(scd, "CLOSED_FOLDERS", 3)
    path, folders = files.scratch_dir(spark, "dim"), []
    for n in range(10):
        listed = [("1", "a")] + ([("2", "b")] if n % 2 else [])
        scd.apply_snapshot(snapshot(spark, *listed), path, DAY[n], f"{DAY[n]} 06:00:00")
        folders.append(len(files.subdirectories(spark, path)))
    assert max(folders) <= 2 * (scd.CLOSED_FOLDERS + 2)
    got = versions(scd.read_stations(spark, path))
    assert [v for v in got if v[0] == "1"] == [("1", "a", True, DAY[0], None)]
    assert len([v for v in got if v[0] == "2"]) == 9
    stored = scd.versions.state(spark, path)
    assert spark.read.parquet(f"{path}/{stored['open']}").count() == 2


def test_long_history_is_not_written_again(spark, monkeypatch):
    monkeypatch.setattr(scd, "CLOSED_FOLDERS", 4)
    monkeypatch.setattr(scd, "MERGED_FOLDERS", 3)
    path = files.scratch_dir(spark, "dim")
    many = [(f"m{i}", "x" * 50 + str(i)) for i in range(2000)]
    scd.apply_snapshot(snapshot(spark, ("1", "a"), *many), path, DAY[0], f"{DAY[0]} 06:00:00")
    scd.apply_snapshot(snapshot(spark, ("1", "a")), path, DAY[1], f"{DAY[1]} 06:00:00")  # closes 2,000 versions
    long = max(scd.versions.state(spark, path)["closed"], key=lambda c: files.total_bytes(spark, f"{path}/{c}"))
    merged = set()
    for n in range(2, 10):
        listed = [("1", "a")] + ([("2", "b")] if n % 2 else [])
        scd.apply_snapshot(snapshot(spark, *listed), path, DAY[n], f"{DAY[n]} 06:00:00")
        closed = scd.versions.state(spark, path)["closed"]
        assert long in closed and len(closed) <= scd.CLOSED_FOLDERS
        merged |= {c for c in closed if c.startswith("closed-all")}
    assert len(merged) >= 2
    assert scd.read_stations(spark, path).where("end_date IS NOT NULL").count() == 2000 + 6


def test_duplicate_station_is_named(spark):
    with pytest.raises(DuplicateKeyError, match="'station_id': '7'"):
        scd.apply_snapshot(
            snapshot(spark, ("7", "a"), ("7", "b")), files.scratch_dir(spark, "dim"), DAY[0], f"{DAY[0]} 06:00:00"
        )


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_as_of_takes_the_half_open_interval(spark, broadcast_bytes):
    d = dim(spark, ("1", "a", True, DAY[0], DAY[3]), ("1", "b", False, DAY[3], None))
    fact = spark.createDataFrame(
        [("1", DAY[0]), ("1", DAY[2]), ("1", DAY[3]), ("1", D(2020, 1, 1)), ("9", DAY[0]), (None, DAY[0])],
        "station_id string, day date",
    )
    got = scd.scd_as_of(fact, d, "day", broadcast_bytes=broadcast_bytes)
    assert rows(got, "station_id", "day", "name") == sorted(
        [
            ("1", DAY[0], "a"), ("1", DAY[2], "a"), ("1", DAY[3], "b"),
            ("1", D(2020, 1, 1), None), ("9", DAY[0], None), (None, DAY[0], None),
        ],
        key=repr,
    )
