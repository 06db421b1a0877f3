"""Every registered query against its SQL."""

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

from velotide.registry import ORACLE, QUERIES

SF_DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=SF_DIRS, ids=["sf0.001", "sf0.01"])
def tables(request):
    con = duck(request.param)
    yield request.param, con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    sf_dir, con = tables
    difference, count = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert difference == ""
    assert count > 0 or sf_dir.endswith("sf0.001")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["status_increment_stored", "warehouse_day"])
def test_readings_of_any_age_are_loaded(spark, name, tmp_path):
    """A hundred readings, moved 200 days back."""
    source = "/root/testdata/sf0.001"
    for table in ("orders", "supplier"):
        spark.read.parquet(f"{source}/{table}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    events = spark.read.parquet(f"{source}/events.parquet")
    moved = F.when(F.col("event_id") % 10 == 0, F.col("ts") - F.expr("INTERVAL 200 DAYS")).otherwise(F.col("ts"))
    events.withColumn("ts", moved).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duck(source)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    difference, count = compare(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name])
    assert difference == "" and count > 0
