import datetime as dt
import glob

import pyarrow.parquet as parquet
import pytest
from helpers import rows
from pyspark.sql import functions as F

from velotide.operators import dedup, merge
from velotide.schemas import FACT_STATUS, STATUS_STAGING
from velotide.sources import files


def staging(spark, *readings):
    """Readings (UTC time, station, bikes)."""
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(t), s, True, True, True, 10, b, 0, 0, b) for t, s, b in readings],
        STATUS_STAGING,
    )


def empty_fact(spark):
    return spark.createDataFrame([], FACT_STATUS)


def bikes(fact):
    return rows(fact, "station_id", "utc_timestamp", "num_bikes_available")


def test_dedup_keeps_one_row_by_full_order(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 1, 3), ("a", None, 7), ("a", None, 7)], "k string, t int, v int")
    assert rows(dedup.dedup_keep_one(df, ["k", "t"])) == [("a", 1, 3), ("a", None, 7)]


def test_dedup_without_other_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(dedup.dedup_keep_one(df, ["k"])) == [("a",), ("b",)]


def test_window_ends_are_local_dates(spark):
    # 05:00Z is midnight in New York.
    got = merge.status_increment(
        empty_fact(spark),
        staging(
            spark,
            ("2024-01-14T04:59:59", "1", 1),  # 13th, two days before
            ("2024-01-14T05:00:00", "1", 2),  # 14th
            ("2024-01-16T04:59:59", "1", 3),  # 15th
            ("2024-01-16T05:00:00", "1", 4),  # 16th
        ),
        "2024-01-15",
    )
    assert [r[2] for r in bikes(got)] == [2, 3]


def test_corrected_reading_is_not_taken(spark):
    first = merge.status_increment(
        empty_fact(spark), staging(spark, ("2024-01-15T12:00:00", "1", 5)), "2024-01-15"
    )
    second = merge.status_increment(
        first,
        staging(spark, ("2024-01-15T12:00:00", "1", 9), ("2024-01-15T12:05:00", "1", 6)),
        "2024-01-15",
    )
    assert [r[2] for r in bikes(second)] == [5, 6]


def test_both_instants_of_the_clock_change_survive_separate_runs(spark):
    early = staging(spark, ("2024-11-03T05:30:00", "1", 1))
    both = staging(spark, ("2024-11-03T05:30:00", "1", 1), ("2024-11-03T06:30:00", "1", 2))
    fact = merge.status_increment(empty_fact(spark), early, "2024-11-03")
    fact = merge.status_increment(fact, both, "2024-11-03")
    assert [r[2] for r in bikes(fact)] == [1, 2]
    assert fact.select("est_datetime").distinct().count() == 1


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    source = spark.createDataFrame([("a", 8), (None, 9), ("b", 10), ("b", 11)], "k string, v int")
    assert rows(merge.insert_only_merge(target, source, ["k"])) == [
        ("a", 1), ("b", 10), ("b", 11), (None, 2), (None, 9),
    ]


def test_conflicts_name_the_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert rows(dedup.key_conflicts(df, ["k"])) == [("a", 2)]
    with pytest.raises(dedup.DuplicateKeyError, match="'k': 'a'"):
        dedup.assert_unique(df, ["k"])
    dedup.assert_unique(df, ["k", "v"])


def test_stored_increment_is_idempotent(spark):
    path = files.scratch_dir(spark, "fact")
    day = staging(spark, ("2024-01-15T12:00:00", "1", 5), ("2024-01-16T01:00:00", "2", 6))
    merge.load_status_increment(day, path, "2024-01-15")
    merge.load_status_increment(day, path, "2024-01-15")
    stored = merge.read_status_fact(spark, path)
    assert rows(stored, "station_id", "est_date") == [
        ("1", dt.date(2024, 1, 15)), ("2", dt.date(2024, 1, 15)),
    ]


def test_stored_increment_completes_a_partial_append(spark):
    path = files.scratch_dir(spark, "fact")
    day = staging(spark, *[(f"2024-01-15T12:{m:02d}:00", "1", m) for m in range(30)])
    merge.load_status_increment(day.filter(F.col("num_bikes_available") < 11), path, "2024-01-15")
    merge.load_status_increment(day, path, "2024-01-15")
    stored = merge.read_status_fact(spark, path)
    assert sorted(r[0] for r in stored.select("num_bikes_available").collect()) == list(range(30))


def test_a_run_reads_only_the_folders_of_its_window(spark):
    path = files.scratch_dir(spark, "fact")
    days = staging(spark, *[(f"2024-01-{d:02d}T12:00:00", "1", d) for d in range(1, 20)])
    merge.load_status_increment(days, path, "2024-01-19", days=30)
    new = merge.status_new_rows(merge.read_status_fact(spark, path), days, "2024-01-15")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(est_date" in plan
    assert new.count() == 0

    dates = (dt.date(2024, 1, 14), dt.date(2024, 1, 15))
    # Stored instants carry their range, by which a filter skips row groups.
    file = glob.glob(f"{path}/est_date=2024-01-15/*.parquet")[0]
    group = parquet.ParquetFile(file).metadata.row_group(0)
    instant = next(c for c in map(group.column, range(8)) if c.path_in_schema == "utc_timestamp")
    assert instant.statistics.min == instant.statistics.max == dt.datetime(
        2024, 1, 15, 12, tzinfo=dt.timezone.utc
    )

    files_read = merge.read_status_fact(spark, path, dates).inputFiles()
    assert {f.split("est_date=")[1][:10] for f in files_read} == {"2024-01-14", "2024-01-15"}
