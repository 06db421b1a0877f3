"""Status feed as a stream: read, land raw, decode and append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velotide import schemas
from velotide.functions.clock import require_utc
from velotide.operators.decode import decode_status
from velotide.sources import files

# In place of a query's identity, for what ``compact`` has merged.
COMPACTED = "compacted"
# Folders with a file per query: its last batch that is whole, its last that was merged.
# Readers of the table pass over names with an underscore.
WRITTEN, MERGED = "_written", "_merged"

# -- sources -------------------------------------------------------------------


def read_status_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Payloads of a Kafka topic from the latest offset on.

    The start applies to the first run only; later runs go on where the writer's
    checkpoint stopped.  For a topic with few partitions pass ``minPartitions``
    to read it in parallel, for a backlog ``maxOffsetsPerTrigger`` to bound the
    batches.
    """
    settings = kafka_options(servers, topic, options)
    stream = spark.readStream.format("kafka").options(**settings).load()
    return stream.select("value", F.col("timestamp").alias("ingest_ts"))


def kafka_options(
    servers: str, topic: str, options: dict[str, str] | None = None
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **(options or {}),
    }


def replay_raw(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Landed payloads as a stream, in bounded batches."""
    return (
        spark.readStream.schema(schemas.RAW_LANDING)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


# -- sinks ---------------------------------------------------------------------


def land_raw(
    payloads: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store every payload as it came, in folders by arrival date.

    Arrival is the ``ingest_ts`` of the source, else the time of the batch.
    """
    require_utc()
    if "ingest_ts" not in payloads.columns:
        payloads = payloads.withColumn("ingest_ts", F.current_timestamp())
    landed = payloads.select(
        F.col("value").cast("binary").alias("value"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        F.to_date("ingest_ts").alias("ingest_date"),
    )
    return _append(landed, path, "ingest_date", checkpoint, trigger)


def append_status(
    payloads: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Decode a stream of payloads and append the rows to the status table."""
    require_utc()
    dated = decode_status(payloads).withColumn("utc_date", F.to_date("utc_timestamp"))
    return _append(dated, path, "utc_date", checkpoint, trigger)


def _append(
    rows: DataFrame, path: str, date: str, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    """Append a stream in folders by ``date``.

    Spark may hand over a batch again after a failure.  Each batch owns the
    folders of its query and batch number and replaces them, so nothing is
    appended twice.  The query's identity lives in the checkpoint: a new
    checkpoint starts new folders and never replaces those of the old query.
    """
    return (
        rows.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, path, date))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_batch(batch: DataFrame, number: int, path: str, date: str) -> None:
    """Write one micro-batch.  It is read once; no count or cache goes before.

    The date comes first in the layout, so that a reader of some days lists the
    folders of those days only, however many batches there have been.  Rows are
    gathered by date first: a batch writes one file per date, and more only for a
    date that holds much of a large batch.
    """
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        raise RuntimeError("write_batch runs inside a streaming query only")
    (
        batch.hint("rebalance", F.col(date))
        .withColumns({"query": F.lit(query), "batch": F.lit(number)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date, "query", "batch")
        .parquet(path)
    )
    files.replace_text(spark, f"{path}/{WRITTEN}/{query}", str(number))


def compact(spark: SparkSession, path: str, date: str, before: dt.date) -> list[str]:
    """Merge the batches of each closed date (earlier than ``before``) into one folder.

    Returns the names of the dates merged.  Run it where no batch still writes to
    those dates and no job reads them.  The merged rows are complete in a hidden
    folder before the batches go; a run that was cut off is finished by the next.
    """
    merged = []
    for folder in files.day_folders(spark, path, date, dt.date.min, before - dt.timedelta(days=1)):
        hidden = f"{path}/_compact-{folder.rsplit('=', 1)[1]}"
        queries = files.subdirectories(spark, folder)
        if not files.is_complete(spark, hidden):
            batches = [f"{folder}/{q}/{b}" for q in queries for b in files.subdirectories(spark, f"{folder}/{q}")]
            if len(batches) < 2:
                continue
            rows = spark.read.parquet(*batches)
            rows.hint("rebalance").write.mode("overwrite").parquet(hidden)
        for name in queries:
            _note_merged(spark, path, folder, name)
            files.delete(spark, f"{folder}/{name}")
        files.make_folder(spark, f"{folder}/query={COMPACTED}")
        files.move(spark, hidden, f"{folder}/query={COMPACTED}/batch=0")
        merged.append(folder.rsplit("/", 1)[1])
    return merged


def _note_merged(spark: SparkSession, path: str, folder: str, name: str) -> None:
    """Note the last batch of the folder ``query=<id>``, for readers that tell batches apart."""
    query = name.removeprefix("query=")
    batches = [int(b.removeprefix("batch=")) for b in files.subdirectories(spark, f"{folder}/{name}")]
    note = f"{path}/{MERGED}/{query}"
    before = int(files.read_text(spark, note) or -1)
    if query != COMPACTED and batches and max(batches) > before:
        files.replace_text(spark, note, str(max(batches)))


def read_status_table(
    spark: SparkSession, path: str, dates: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """The appended rows and their folder column ``utc_date``.

    With ``dates``, only the folders of those UTC dates are listed and read.
    """
    if dates is None:
        folders = [path]
    else:
        folders = files.day_folders(spark, path, "utc_date", *dates)
    if not folders:
        return spark.createDataFrame([], schemas.STATUS_TABLE)
    table = spark.read.schema(schemas.STATUS_TABLE).option("basePath", path).parquet(*folders)
    return table.select(*schemas.STATUS_TABLE.fieldNames())
