import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from velotide.sources import files
from velotide.streaming import ingest


def payloads(spark, *epochs):
    texts = [
        json.dumps({"data": {"stations": [{"station_id": f"hub_{n}", "last_reported": e, "num_bikes_available": n}
                                          for n in (1, 2)]}})
        for e in epochs
    ]
    return spark.createDataFrame([(t.encode(),) for t in texts], "value binary").withColumn(
        "ingest_ts", F.timestamp_seconds(F.lit(epochs[0]))
    )


DAY1, DAY2 = 1735689600, 1735776000  # 2025-01-01, 2025-01-02


def feed(spark, path, *epochs):
    """Add one file per call to a folder that serves as the stream."""
    payloads(spark, *epochs).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, per_batch=1):
    return (
        spark.readStream.schema("value binary, ingest_ts timestamp")
        .option("maxFilesPerTrigger", per_batch)
        .parquet(path)
    )


def paths(spark):
    base = files.scratch_dir(spark, "stream")
    return f"{base}/in", f"{base}/out", f"{base}/checkpoint"


def append(spark, source, target, checkpoint):
    ingest.append_status(stream(spark, source), target, checkpoint).awaitTermination()


def readings(spark, target):
    return rows(ingest.read_status_table(spark, target), "station_id", "utc_timestamp")


def test_restart_goes_on_where_it_stopped(spark):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1)
    feed(spark, source, DAY1 + 600, DAY2)
    append(spark, source, target, checkpoint)
    first = readings(spark, target)
    assert len(first) == 6
    append(spark, source, target, checkpoint)
    assert readings(spark, target) == first
    feed(spark, source, DAY2 + 600)
    append(spark, source, target, checkpoint)
    assert len(readings(spark, target)) == 8


def test_a_replayed_batch_is_not_appended_twice(spark):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1)
    feed(spark, source, DAY1 + 600)
    append(spark, source, target, checkpoint)
    before = readings(spark, target)
    # As if the writer had died after the write and before noting the batch done.
    for name in ("1", ".1.crc"):
        files.delete(spark, f"{checkpoint}/commits/{name}")
    append(spark, source, target, checkpoint)
    assert readings(spark, target) == before


def test_a_new_checkpoint_does_not_overwrite_the_old_rows(spark):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1)
    append(spark, source, target, checkpoint)
    append(spark, source, target, checkpoint + "-2")
    assert len(readings(spark, target)) == 4
    assert len(files.subdirectories(spark, f"{target}/utc_date=2025-01-01")) == 2


def test_rows_lie_in_folders_by_date(spark):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1, DAY2)
    append(spark, source, target, checkpoint)
    day = ingest.read_status_table(spark, target).filter("utc_date = date'2025-01-02'")
    assert "PartitionFilters: [isnotnull(utc_date" in day._jdf.queryExecution().executedPlan().toString()
    assert rows(day, "utc_timestamp") == [(dt.datetime(2025, 1, 2),)] * 2

    dates = (dt.date(2025, 1, 2), dt.date(2025, 1, 9))
    alone = ingest.read_status_table(spark, target, dates)
    assert rows(alone) == rows(day)
    assert all("utc_date=2025-01-02" in file for file in alone.inputFiles())
    nothing = ingest.read_status_table(spark, target, (dt.date(2030, 1, 1), dt.date(2030, 1, 2)))
    assert nothing.count() == 0 and nothing.schema == day.schema


def test_rows_without_time_are_kept(spark):
    source, target, checkpoint = paths(spark)
    text = '{"data": {"stations": [{"station_id": "hub_1"}]}}'
    spark.createDataFrame([(text.encode(),)], "value binary").withColumn(
        "ingest_ts", F.current_timestamp()
    ).write.parquet(source)
    append(spark, source, target, checkpoint)
    assert readings(spark, target) == [("1", None)]


def test_landed_payloads_replay_to_the_same_rows(spark):
    source, target, checkpoint = paths(spark)
    landing = target + "-raw"
    feed(spark, source, DAY1)
    feed(spark, source, DAY2)
    for _ in range(2):
        ingest.land_raw(stream(spark, source), landing, checkpoint + "-raw").awaitTermination()
    landed = spark.read.parquet(landing)
    assert landed.columns == ["value", "ingest_ts", "ingest_date", "query", "batch"]
    assert landed.count() == 2
    replay = ingest.replay_raw(spark, landing, max_files_per_trigger=1)
    ingest.append_status(replay, target, checkpoint).awaitTermination()
    append(spark, source, target + "-direct", checkpoint + "-direct")
    assert readings(spark, target) == readings(spark, target + "-direct")
    assert len(readings(spark, target)) == 4


def test_landing_without_arrival_time_uses_the_batch_time(spark):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1)
    ingest.land_raw(stream(spark, source).select("value"), target, checkpoint).awaitTermination()
    landed = spark.read.parquet(target).first()
    assert landed["ingest_ts"].date() >= dt.date(2025, 1, 2)
    assert landed["ingest_date"] == landed["ingest_ts"].date()


def test_kafka_options():
    assert ingest.kafka_options("host:9092", "status", {"minPartitions": "64"}) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "status",
        "startingOffsets": "latest",
        "minPartitions": "64",
    }


def test_kafka_is_asked_for(spark):
    """The connector is not part of this image, so only the request is seen."""
    with pytest.raises(Exception, match="kafka"):
        ingest.read_status_stream(spark, "host:9092", "status")


def data_files(spark, folder):
    return len(spark.read.parquet(folder).inputFiles())


def many_dates(spark, path, dates, per_date):
    days = spark.range(dates * per_date, numPartitions=4).select(
        (F.lit(DAY1) + (F.col("id") % dates) * 86400).alias("e")
    )
    text = F.format_string('{"data": {"stations": [{"station_id": "hub_1", "last_reported": %d}]}}', "e")
    days.select(text.cast("binary").alias("value"), F.timestamp_seconds("e").alias("ingest_ts")).write.parquet(path)


def test_a_batch_writes_one_file_per_date(spark):
    source, target, checkpoint = paths(spark)
    many_dates(spark, source, 30, 40)
    ingest.append_status(stream(spark, source, 100), target, checkpoint).awaitTermination()
    ingest.land_raw(stream(spark, source, 100), target + "-raw", checkpoint + "-raw").awaitTermination()
    assert data_files(spark, target) == 30
    assert data_files(spark, target + "-raw") == 30
    assert ingest.read_status_table(spark, target).count() == 1200


def test_closed_dates_are_compacted(spark):
    source, target, checkpoint = paths(spark)
    for epoch in (DAY1, DAY1 + 60, DAY1 + 120, DAY2, DAY2 + 60):
        feed(spark, source, epoch)
    append(spark, source, target, checkpoint)
    before = readings(spark, target)
    first, second = (f"{target}/utc_date=2025-01-0{n}" for n in (1, 2))
    assert data_files(spark, first) == 3
    assert ingest.compact(spark, target, "utc_date", dt.date(2025, 1, 2)) == ["utc_date=2025-01-01"]
    assert (data_files(spark, first), data_files(spark, second)) == (1, 2)
    assert readings(spark, target) == before
    assert ingest.compact(spark, target, "utc_date", dt.date(2025, 1, 2)) == []
    # The stream goes on, also for a date that was closed.
    feed(spark, source, DAY1 + 180)
    append(spark, source, target, checkpoint)
    assert len(readings(spark, target)) == len(before) + 2
    assert ingest.compact(spark, target, "utc_date", dt.date(2025, 1, 2)) == ["utc_date=2025-01-01"]
    assert len(readings(spark, target)) == len(before) + 2


def test_a_compaction_that_was_cut_off_is_finished(spark, monkeypatch):
    source, target, checkpoint = paths(spark)
    feed(spark, source, DAY1)
    feed(spark, source, DAY1 + 60)
    append(spark, source, target, checkpoint)
    before = readings(spark, target)
    move = files.move

    def broken(*_):
        raise OSError("cut off")

    monkeypatch.setattr(files, "move", broken)
    with pytest.raises(OSError):
        ingest.compact(spark, target, "utc_date", dt.date(2025, 1, 2))
    monkeypatch.setattr(files, "move", move)
    assert ingest.compact(spark, target, "utc_date", dt.date(2025, 1, 2)) == ["utc_date=2025-01-01"]
    assert readings(spark, target) == before
