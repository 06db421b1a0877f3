"""What the text operators share: tokens, row-wise functions, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide import session
from velotide.sources import files

#: bytes.split() without arguments splits on exactly \x20 and \x09-\x0D, and
#: bytes.lower() changes exactly A-Z.
WORD = r"[^\x20\x09-\x0D]+"


#: Texts are long, so fewer rows go to Python at a time than by default; a worker
#: then holds some MB of a batch, not its share of 10,000 documents.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the package's settings and those of the text operators."""
    session.prepare(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def raw(text: Column) -> Column:
    """The UTF-8 bytes of a text; NULL counts as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_function(fields: str, fn: Callable[[list[bytes]], dict]) -> Callable[[Column], Column]:
    """A vectorised column function from UTF-8 bytes to a struct.

    ``fn`` gets the texts of an Arrow batch and returns a list or array for each
    field.  Marked as not deterministic, so that a filter on its result isn't
    pushed below it and the work done twice.
    """
    names = [f.split()[0] for f in fields.split(", ")]

    @F.pandas_udf(fields)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = fn(texts.tolist())
            yield pd.DataFrame({n: list(out[n]) for n in names})

    run = run.asNondeterministic()
    return lambda text: run(raw(text))


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the cluster's shared folder and read back.

    This cuts the lineage: what follows survives lost executors without running
    the steps before it again.
    """
    spark = df.sparkSession
    path = files.scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, checkpointed; unlike stored ones they keep their partitioning.

    A plan that is still to be adapted has none to keep, so this job alone isn't.
    """
    spark, adaptive = df.sparkSession, "spark.sql.adaptive.enabled"
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(files.scratch_dir(spark, "checkpoints"))
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        # The copy is planned under the setting, whenever the plan was built.
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(adaptive, before)


def partitions_for(spark: SparkSession, size: int, per_partition: int) -> int:
    """Shuffle partitions for ``size`` bytes, never fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // per_partition + 1)


def pack(text: bytes) -> bytes:
    """Compressed, for texts that go through shuffles more than once; '' stays ''."""
    size = len(text).to_bytes(8, "little")
    return size + pa.compress(text, codec="zstd", asbytes=True) if text else b""


def unpack(blob) -> bytes:
    blob = blob.as_py() if isinstance(blob, pa.Scalar) else blob
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True) if blob else b""


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
