"""Tables in buckets: joins that leave the large side where it is."""

import pytest
from helpers import final_plan, rows

from velotide.operators.merge import insert_only_merge, unmatched
from velotide.sources import buckets, files

KEY = ["station_id", "at"]


def fact(spark, n, first=0):
    return spark.range(first, first + n).selectExpr("concat('s', id % 7) AS station_id", "id AS at", "id * 2 AS bikes")


@pytest.fixture
def stored(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="true")
    path = files.scratch_dir(spark, "bucketed")
    return path, buckets.store(fact(spark, 1000), path, KEY, 4)


def test_a_merge_shuffles_what_is_new_only(spark, stored, conf):
    conf(adaptive__enabled="false")  # one plan to look at
    _, table = stored
    new = fact(spark, 300, 900)
    fresh = unmatched(table, new, KEY)
    lines = final_plan(fresh).splitlines()
    (shuffle,) = [i for i, line in enumerate(lines) if "Exchange" in line]
    (scan,) = [i for i, line in enumerate(lines) if "FileScan" in line]
    assert "hashpartitioning(station_id" in lines[shuffle] and shuffle < scan
    # The shuffle's own branch ends in the range of new rows; the scan is on the other one.
    assert any("Range" in line for line in lines[shuffle:scan])
    assert rows(fresh) == rows(fact(spark, 200, 1000))
    assert rows(insert_only_merge(table, new, KEY)) == rows(fact(spark, 1200))


def test_equal_buckets_join_without_a_shuffle(spark, stored):
    _, table = stored
    other = buckets.store(fact(spark, 500), files.scratch_dir(spark, "bucketed"), KEY, 4)
    joined = table.join(other.withColumnRenamed("bikes", "more"), KEY)
    assert "Exchange" not in final_plan(joined)
    assert joined.count() == 500


def test_rows_are_added_in_their_buckets(spark, stored):
    path, _ = stored
    buckets.append(fact(spark, 100, 1000), path)
    table = buckets.read(spark, path)
    assert rows(table) == rows(fact(spark, 1100))
    joined = table.join(buckets.read(spark, path).withColumnRenamed("bikes", "more"), KEY)
    assert "Exchange" not in final_plan(joined) and joined.count() == 1100


def test_another_session_finds_the_buckets(spark, stored):
    path, table = stored
    spark.sql(f"DROP TABLE {buckets._name(path)}")  # as in a catalogue that has gone
    again = buckets.read(spark, path)
    assert rows(again) == rows(fact(spark, 1000))
    joined = again.join(buckets.read(spark, path).withColumnRenamed("bikes", "more"), KEY)
    assert "Exchange" not in final_plan(joined)
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, path + "-none")


def test_a_table_is_replaced(spark, stored):
    path, _ = stored
    assert rows(buckets.store(fact(spark, 10), path, ["station_id"], 2)) == rows(fact(spark, 10))
