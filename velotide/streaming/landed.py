"""Landed payloads as a stream source with a start of its own.

A file stream reads a folder from its first file on and keeps every name it has
seen.  This source starts at the latest batch, as the message feed does, and its
offset is one number per landing query: the last batch that is whole (``ingest``
notes it once the batch is written).  A batch owns its folders, so an offset range
names its files, and a restart reads each later row once.

Planning and reading use Arrow's file systems, which must reach the folder.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from velotide import schemas
from velotide.streaming.ingest import COMPACTED, MERGED, WRITTEN

LATEST, EARLIEST = "latest", "earliest"


class BatchesGoneError(RuntimeError):
    """Batches that were not read yet have been merged, so their rows can't be told apart."""


@dataclass
class LandedFile(InputPartition):
    path: str


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a path as Spark writes it; ``file:`` paths may hold any character."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path.rstrip("/")))


class LandedReader(DataSourceStreamReader):
    def __init__(self, schema, options: dict[str, str]):
        self.fields = to_arrow_schema(schema)
        self.fs, self.path = file_system(options["path"])
        self.start_at = options.get("startingoffsets", LATEST)
        # Where the first start is noted; a start without rows leaves nothing in a checkpoint.
        self.noted = file_system(options["startnote"]) if "startnote" in options else None
        if self.start_at not in (LATEST, EARLIEST):
            raise ValueError(f"startingOffsets is {LATEST} or {EARLIEST}")

    def _names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))
        return sorted(i.base_name for i in found)

    def _numbers(self, kind: str) -> dict[str, int]:
        """The number noted for each landing query."""
        out = {}
        for name in self._names(f"{self.path}/{kind}"):
            if re.fullmatch(r"[0-9a-f-]{36}", name):
                with self.fs.open_input_stream(f"{self.path}/{kind}/{name}") as f:
                    out[name] = int(f.read())
        return out

    def initialOffset(self) -> dict:
        if self.noted:
            system, path = self.noted
            if system.get_file_info(path).type == arrow_fs.FileType.File:
                with system.open_input_stream(path) as f:
                    return json.loads(f.read())
        start = {} if self.start_at == EARLIEST else self.latestOffset()
        if self.noted:
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(path) as f:
                f.write(json.dumps(start).encode())
        return start

    def latestOffset(self) -> dict:
        return self._numbers(WRITTEN)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """The files of all batches after ``start`` up to ``end``, each a partition."""
        merged = self._numbers(MERGED)
        late = [q for q, n in merged.items() if start.get(q, -1) < min(n, end.get(q, -1))]
        if late and start:
            raise BatchesGoneError(f"batches of {late} were merged before they were read")
        out = []
        for date in self._names(self.path):
            if not re.fullmatch(r"[a-z_]+=\d{4}-\d{2}-\d{2}", date):
                continue
            for query in self._names(f"{self.path}/{date}"):
                name = query.removeprefix("query=")
                for batch in self._names(f"{self.path}/{date}/{query}"):
                    number = int(batch.removeprefix("batch="))
                    wanted = not start if name == COMPACTED else start.get(name, -1) < number <= end.get(name, -1)
                    if wanted:
                        folder = f"{self.path}/{date}/{query}/{batch}"
                        out += [LandedFile(f"{folder}/{f}") for f in self._names(folder) if f.endswith(".parquet")]
        return out

    def read(self, partition: LandedFile) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=self.fields.names):
                yield from pa.Table.from_batches([batch]).select(self.fields.names).cast(self.fields).to_batches()


class LandedBatches(DataSource):
    """``spark.readStream.format("landed_batches").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "landed_batches"

    def schema(self) -> str:
        return ", ".join(schemas.RAW_LANDING.split(", ")[:-1])  # the date is that of the folder

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(schema, {k.lower(): v for k, v in self.options.items()})


def read_landed_stream(spark: SparkSession, path: str, checkpoint: str, start: str = LATEST) -> DataFrame:
    """Payloads (value, ingest_ts) that ``land_raw`` stored at ``path``, as a stream.

    The first start reads nothing that had landed before it, or with ``start`` =
    'earliest' everything; it is noted beside ``checkpoint``, the writer's.  Later
    starts go on where the checkpoint stopped.  Batches that wait to be read must
    not be merged (``compact``); the stream fails rather than lose or repeat them.
    """
    spark.dataSource.register(LandedBatches)
    return (
        spark.readStream.format(LandedBatches.name())
        .option("path", path)
        .option("startingOffsets", start)
        .option("startNote", f"{checkpoint.rstrip('/')}-start/offset.json")
        .load()
    )
