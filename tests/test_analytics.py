import datetime as dt
import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from velotide.functions import clock
from velotide.operators.dedup import dedup_keep_one
from velotide.operators.reconcile import key_reconcile
from velotide.operators.trips import trip_fact
from velotide.plans import availability, demand, stations, weather
from velotide.schemas import FACT_STATUS, TRIP_CSV
from velotide.sources.feeds import weather_rows

T = dt.datetime


def test_trip_fact(spark):
    def trip(trip_id, category, bike):
        now = T(2024, 1, 2, 8)
        return (trip_id, 7, now, now, "1", "2", "b", 30, category, "Month", bike)

    staged = spark.createDataFrame(
        [
            trip(" 12 ", "Round Trip", "standard"),
            trip("13", "One Way", "Standard"),
            trip("14", None, None),
            trip("15", "round trip", "electric"),
        ],
        TRIP_CSV,
    )
    assert rows(trip_fact(staged), "trip_id", "is_round_trip", "bike_type") == [
        (12, True, "classic"), (13, False, "Standard"), (14, None, None), (15, False, "electric"),
    ]
    for bad in ("12.0", "0x1F", "abc"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            trip_fact(spark.createDataFrame([trip(bad, None, None)], TRIP_CSV)).collect()


def moves(spark, *pairs):
    return spark.createDataFrame(pairs, "start_station string, end_station string")


def test_utilisation(spark):
    got = stations.station_utilisation(moves(spark, ("a", "b"), ("a", "a"), ("b", None), (None, "c")))
    assert rows(got) == [("a", 2, 1, 3, -1), ("b", 1, 1, 2, 0), ("c", 0, 1, 1, 1)]


def test_tiers_against_brute_force(spark):
    rng = random.Random(4)
    totals = [int(rng.paretovariate(1.1)) for _ in range(237)]

    def quantile(p):
        ordered, at = sorted(totals), p * (len(totals) - 1)
        low, part = ordered[int(at)], at - int(at)
        high = ordered[min(int(at) + 1, len(totals) - 1)]
        return low + (high - low) * part

    low, high = quantile(0.1), quantile(0.9)
    want = Counter("over" if t >= high else "under" if t <= low else "normal" for t in totals)
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(totals)], "station_id string, total bigint")
    assert Counter(r["tier"] for r in stations.utilisation_tier(df).collect()) == want


def test_busiest_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 5), ("b", 5), ("a", 1)], "station_id string, total bigint")
    assert [tuple(r) for r in stations.busiest_stations(df, 2).collect()] == [("b", 5), ("c", 5)]


def test_peak_hours_break_ties_by_hour(spark):
    starts = [T(2024, 1, 7, h) for h in (8, 8, 18, 18, 3)]
    trips = spark.createDataFrame([(s,) for s in starts], "start_time timestamp_ntz")
    assert [tuple(r) for r in demand.peak_hours(trips, 2).collect()] == [(8, 2), (18, 2)]
    assert rows(demand.demand_by_dow(trips)) == [(1, 5)]  # a Sunday


def fact(spark, *readings):
    """Readings (station, local time, bikes, docks)."""
    return spark.createDataFrame(
        [(t, s, d, b, 0, 0, b, t) for s, t, b, d in readings], FACT_STATUS
    )


def test_fill_of_no_bikes_and_no_docks_is_unknown(spark):
    t = T(2024, 1, 1)
    got = availability.station_fill(fact(spark, ("a", t, 0, 0), ("b", t, 0, 0), ("b", t, 3, 1)))
    assert rows(got) == [("a", 1, None, 1.0, 1.0), ("b", 2, 0.75, 0.5, 0.5)]


def test_latest_status(spark):
    df = spark.createDataFrame(
        [("a", T(2024, 1, 1), 1), ("a", T(2024, 1, 2), 2), ("a", T(2024, 1, 2), 3), ("a", None, 9), ("b", None, 4)],
        "station_id string, utc_timestamp timestamp, num_bikes_available int",
    )
    assert rows(availability.latest_status(df)) == [("a", T(2024, 1, 2), 3), ("b", None, 4)]


def weather_frame(spark, *readings):
    return spark.createDataFrame(
        readings, "date string, temperature_2m double, rain double, snowfall double"
    )


def test_weather_of_the_clock_change_hour_counts_trips_once(spark):
    readings = weather_frame(
        spark,
        ("2024-11-03T05:00:00+00:00", 10.0, 0.0, 0.0),
        ("2024-11-03T05:00:00+00:00", 10.0, 0.0, 0.0),  # loaded twice
        ("2024-11-03T06:00:00+00:00", 20.0, 2.0, 0.0),
        ("2024-11-03T07:00:00+00:00", -0.5, 0.0, 1.0),
    )
    trips = spark.createDataFrame(
        [(T(2024, 11, 3, 1, m),) for m in (0, 10, 59)] + [(T(2024, 11, 3, 2, 5),), (T(2024, 11, 3, 9),)],
        "start_time timestamp_ntz",
    )
    assert rows(weather.weather_by_local_hour(readings)) == [
        (T(2024, 11, 3, 1), 15.0, 1.0, 0.0), (T(2024, 11, 3, 2), -0.5, 0.0, 1.0),
    ]
    assert rows(weather.weather_demand(trips, readings)) == [
        (-10, False, True, 1, 1.0), (10, True, False, 1, 3.0),
    ]


def test_correlation(spark):
    hours = range(6)
    readings = weather_frame(
        spark, *[(f"2024-01-01T{h + 5:02d}:00:00+00:00", float(h), float(-h), 0.0) for h in hours]
    )
    trips = spark.createDataFrame(
        [(T(2024, 1, 1, h, m),) for h in hours for m in range(h + 1)], "start_time timestamp_ntz"
    )
    got = weather.weather_corr(trips, readings).first()
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(-1.0)
    assert got[2] != got[2]  # no snow at all: undefined
    assert weather.weather_corr(trips.limit(0), readings).first() == (None, None, None)


def test_reconcile_reports_keys_some_feed_lacks(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "station_id string")
    got = key_reconcile({"left": keys("a", "a", "b", None), "right": keys("a", "c", "c", None)})
    assert got.columns == ["station_id", "rows_left", "rows_right"]
    assert rows(got) == [("b", 1, 0), ("c", 0, 2), (None, 1, 1)]


def test_reconcile_counts_a_hot_key_before_the_shuffle(spark):
    hot = spark.range(100_000).select(F.lit("7").alias("station_id"))
    got = key_reconcile({"left": hot, "right": hot.filter("false")})
    assert rows(got) == [("7", 100_000, 0)]


def test_unknown_weather_is_neither_rain_nor_snow(spark):
    nan = float("nan")
    reports = spark.createDataFrame(
        [(1704085200, 1704092400, 3600, [5.0, nan], [50.0, nan], [0.0, nan], [0.0, nan], [1.0, nan])],
        """start bigint, end bigint, interval_s int, temperature_2m array<float>,
           relative_humidity_2m array<float>, rain array<float>, snowfall array<float>, cloud_cover array<float>""",
    )
    readings = weather_rows(reports)
    assert readings.filter("isnan(temperature_2m) OR isnan(rain) OR isnan(snowfall)").count() == 0
    trips = spark.createDataFrame([(T(2024, 1, 1, h),) for h in (0, 1, 1)], "start_time timestamp_ntz")
    assert rows(weather.weather_demand(trips, readings)) == [(0, False, False, 1, 1.0), (None, None, None, 1, 2.0)]


def test_correlation_passes_over_unknown_hours(spark):
    known = [(f"2024-01-01T{h + 5:02d}:00:00+00:00", float(h), 0.0, 0.0) for h in range(4)]
    gap = ("2024-01-01T09:00:00+00:00", None, None, None)
    trips = spark.createDataFrame(
        [(T(2024, 1, 1, h, m),) for h in range(5) for m in range(h + 1 if h < 4 else 40)], "start_time timestamp_ntz"
    )
    assert weather.weather_corr(trips, weather_frame(spark, *known, gap)).first()[0] == pytest.approx(1.0)


def test_the_most_complete_and_latest_load_wins(spark):
    loads = spark.createDataFrame(
        [
            ("2024-01-01T05:00:00+00:00", 9.0, 1.0, 0.0, "2024-01-01"),
            ("2024-01-01T05:00:00+00:00", 3.0, 1.0, 0.0, "2024-01-02"),
            ("2024-01-01T05:00:00+00:00", None, 1.0, 0.0, "2024-01-03"),
            ("2024-01-01T06:00:00+00:00", None, None, None, "2024-01-03"),
            ("2024-01-01T06:00:00+00:00", None, 2.0, None, "2024-01-01"),
        ],
        "date string, temperature_2m double, rain double, snowfall double, load_id string",
    )
    assert rows(weather.weather_by_local_hour(loads)) == [
        (T(2024, 1, 1, 0), 3.0, 1.0, 0.0), (T(2024, 1, 1, 1), None, 2.0, None),
    ]


def test_hours_without_trips_count(spark):
    readings = weather_frame(
        spark, *[(f"2024-01-01T{h + 5:02d}:00:00+00:00", 12.0, 0.0, 0.0) for h in range(5)]
    )
    trips = spark.createDataFrame([(T(2024, 1, 1, h),) for h in (1, 1, 1, 1, 3)], "start_time timestamp_ntz")
    # Hours 1 to 3; the first and the last hour lie outside the trips' span.
    assert rows(weather.weather_demand(trips, readings)) == [(10, False, False, 3, pytest.approx(5 / 3))]


def test_hours_that_one_side_lacks(spark):
    trips = spark.createDataFrame([(T(2024, 1, 1, 8),)], "start_time timestamp_ntz")
    readings = fact(spark, ("a", T(2024, 1, 1, 9), 4, 2))
    assert rows(availability.demand_vs_availability(trips, readings)) == [(8, 1, None, None), (9, 0, 4.0, 2.0)]


def test_a_full_reading_beats_a_broken_copy(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 7, 2), ("a", 9, 0), ("b", None, None)], "k string, x int, y int")
    assert rows(dedup_keep_one(df, ["k"])) == [("a", 7, 2), ("b", None, None)]


@pytest.mark.parametrize("use", [
    lambda df: clock.to_local(F.col("t")), lambda df: clock.iso_utc(F.col("t")),
    lambda df: clock.near_window(df, "t", "2024-01-01"),
])
def test_another_session_zone_is_refused(spark, conf, use):
    df = spark.createDataFrame([(T(2024, 1, 1),)], "t timestamp")
    use(df)
    conf(session__timeZone="America/New_York")
    with pytest.raises(RuntimeError, match="New_York"):
        use(df)
