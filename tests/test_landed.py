"""Landed payloads as a stream that starts at the latest batch."""

import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from velotide.sources import files
from velotide.streaming import distinct, ingest, landed


def land(spark, path, *names, day="2025-01-01"):
    """One landing query of its own per call."""
    base = files.scratch_dir(spark, "feed")
    payloads = spark.createDataFrame([(n.encode(),) for n in names], "value binary")
    payloads.withColumn("ingest_ts", F.lit(f"{day} 10:00:00").cast("timestamp")).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("value binary, ingest_ts timestamp").parquet(f"{base}/in")
    ingest.land_raw(stream, path, f"{base}/checkpoint").awaitTermination()


def read_on(spark, path, target, start=landed.LATEST):
    """One run of the reader; what it has stored so far."""
    stream = landed.read_landed_stream(spark, path, f"{target}-checkpoint", start)
    ingest.land_raw(stream, target, f"{target}-checkpoint").awaitTermination()
    if not files.exists(spark, target):
        return []
    rows = spark.read.schema("value binary, ingest_ts timestamp").parquet(target).collect()
    assert {r["ingest_ts"] for r in rows} <= {dt.datetime(2025, 1, d, 10) for d in (1, 2)}
    return sorted(bytes(r["value"]).decode() for r in rows)


def paths(spark):
    return files.scratch_dir(spark, "raw"), files.scratch_dir(spark, "read")


def test_starts_at_latest_and_reads_each_later_row_once(spark):
    raw, target = paths(spark)
    land(spark, raw, "old1", "old2")
    assert read_on(spark, raw, target) == []
    land(spark, raw, "a", "b")  # between the first start, which read nothing, and the next
    land(spark, raw, "c", day="2025-01-02")
    assert read_on(spark, raw, target) == ["a", "b", "c"]
    assert read_on(spark, raw, target) == ["a", "b", "c"]
    land(spark, raw, "d")
    assert read_on(spark, raw, target) == ["a", "b", "c", "d"]


def test_paths_as_spark_writes_them():
    for path in ("/a b/c", "file:/a b/c", "file:///a b/c/"):
        assert landed.file_system(path)[1] == "/a b/c"


def test_starts_before_anything_has_landed(spark):
    raw, target = paths(spark)
    files.make_folder(spark, raw)
    assert read_on(spark, raw, target) == []
    land(spark, raw, "a")
    assert read_on(spark, raw, target) == ["a"]


def test_a_batch_read_again_after_a_failure(spark):
    raw, target = paths(spark)
    land(spark, raw, "old")
    read_on(spark, raw, target)
    land(spark, raw, "a")
    assert read_on(spark, raw, target) == ["a"]
    for name in ("0", ".0.crc"):  # as if the writer had died before noting the batch done
        files.delete(spark, f"{target}-checkpoint/commits/{name}")
    land(spark, raw, "b")
    assert read_on(spark, raw, target) == ["a", "b"]


def test_a_batch_that_is_not_whole_is_not_read(spark):
    raw, target = paths(spark)
    land(spark, raw, "old")
    read_on(spark, raw, target)
    land(spark, raw, "a")
    notes = files.subdirectories(spark, f"{raw}/ingest_date=2025-01-01")
    for query in (n.removeprefix("query=") for n in notes):
        files.delete(spark, f"{raw}/{ingest.WRITTEN}/{query}")
    assert read_on(spark, raw, target) == []


def test_from_the_earliest_with_merged_dates(spark):
    raw, target = paths(spark)
    land(spark, raw, "a")
    land(spark, raw, "b")
    ingest.compact(spark, raw, "ingest_date", dt.date(2025, 1, 2))
    land(spark, raw, "c", day="2025-01-02")
    assert read_on(spark, raw, target, landed.EARLIEST) == ["a", "b", "c"]
    land(spark, raw, "d", day="2025-01-02")
    assert read_on(spark, raw, target, landed.EARLIEST) == ["a", "b", "c", "d"]


def test_merging_what_is_still_to_be_read_fails_the_stream(spark):
    raw, target = paths(spark)
    base = files.scratch_dir(spark, "feed")

    def feed(name):
        payloads = spark.createDataFrame([(name.encode(),)], "value binary")
        payloads.withColumn("ingest_ts", F.lit("2025-01-01 10:00:00").cast("timestamp")).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("value binary, ingest_ts timestamp").parquet(f"{base}/in")
        ingest.land_raw(stream, raw, f"{base}/checkpoint").awaitTermination()

    feed("a")
    read_on(spark, raw, target)
    feed("b")
    feed("c")
    ingest.compact(spark, raw, "ingest_date", dt.date(2025, 1, 2))
    with pytest.raises(StreamingQueryException, match="BatchesGoneError"):
        read_on(spark, raw, target)


# -- readings kept once ----------------------------------------------------------

T0 = 1735689600  # 2025-01-01 00:00 UTC


def payload(*readings):
    stations = [{"station_id": f"hub_{s}", "last_reported": t, "num_bikes_available": n} for s, t, n in readings]
    return json.dumps({"data": {"stations": stations}}).encode()


def keys(df):
    return sorted((r["station_id"], r["utc_timestamp"]) for r in df.select("station_id", "utc_timestamp").collect())


def test_repeated_and_late_readings_over_batches_and_a_restart(spark):
    base = files.scratch_dir(spark, "distinct")
    source, target = f"{base}/in", f"{base}/out"
    feed = [
        payload((1, T0, 5), (2, T0, 6)),
        payload((1, T0, 5), (2, T0 + 600, 7)),  # station 1 repeats itself
        payload((1, T0 + 9 * 3600, 1), (2, T0 + 600, 7)),
        payload((2, T0 + 300, 4), (1, T0 + 9 * 3600, 1)),  # 300 comes hours too late
        payload((1, T0 + 9 * 3600 + 60, 2), (2, T0 + 9 * 3600, 3)),
    ]
    for text in feed:
        rows = spark.createDataFrame([(text,)], "value binary").withColumn("ingest_ts", F.lit("2025-01-01").cast("timestamp"))
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema("value binary, ingest_ts timestamp").parquet(source)
        distinct.append_distinct_status(stream, target, f"{base}/checkpoint").awaitTermination()  # each run is a restart
    kept = ingest.read_status_table(spark, target)
    late = distinct.late_readings(spark.read.parquet(source), kept)
    at = {k: dt.datetime(2025, 1, 1) + dt.timedelta(seconds=k) for k in (0, 300, 600, 9 * 3600, 9 * 3600 + 60)}
    assert keys(kept) == [("1", at[0]), ("1", at[9 * 3600]), ("1", at[9 * 3600 + 60]), ("2", at[0]), ("2", at[600]), ("2", at[9 * 3600])]
    assert keys(late) == [("2", at[300])]


def test_the_state_lets_go_of_old_keys(spark):
    """Twelve hours of readings, an hour a batch: the state holds those of the last hours only."""
    base = files.scratch_dir(spark, "state")
    for hour in range(12):
        texts = [(payload(*[(s, T0 + hour * 3600 + s, 1) for s in range(50)]),)]
        rows = spark.createDataFrame(texts, "value binary").withColumn("ingest_ts", F.lit("2025-01-01").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("value binary, ingest_ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = distinct.append_distinct_status(stream, f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert ingest.read_status_table(spark, f"{base}/out").count() == 600
    assert max(held) <= 50 * 5
