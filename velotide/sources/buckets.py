"""Tables stored in buckets of a key, so that joins on it shuffle only what is new.

Rows of one key lie in one bucket, sorted.  Two tables with equal buckets join bucket
by bucket; a table that isn't stored so is dealt out to the buckets, and the large
one is read where it lies.

Spark keeps the number of buckets and their columns in its catalogue, which may not
outlive the session; a small file beside the rows tells them to the next one.  Choose a
key that no value dominates: a bucket is one task, which run-time skew handling
cannot split.  The status fact goes by station and instant, not by station.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from velotide.sources import files

SPEC = "_buckets"


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def store(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Replace the table at ``path`` with ``df``, in ``buckets`` buckets, and read it back.

    Rows are dealt out by key first, so that a bucket is one file.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    _write(df, path, keys, buckets, "overwrite")
    spec = {"keys": list(keys), "buckets": buckets, "schema": df.schema.toDDL()}
    files.replace_text(spark, f"{path}/{SPEC}", json.dumps(spec))
    return read(spark, path)


def append(df: DataFrame, path: str) -> None:
    """Add rows in the buckets of the table: a file more in each.

    The rows of a bucket are then sorted within files only, and sorted again by a
    join that needs it; ``store`` the table anew now and then.
    """
    spec = _spec(df.sparkSession, path)
    read(df.sparkSession, path)
    _write(df, path, spec["keys"], spec["buckets"], "append")


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode(mode).format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(_name(path))


def _spec(spark: SparkSession, path: str) -> dict:
    text = files.read_text(spark, f"{path}/{SPEC}")
    if text is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    return json.loads(text)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, made known to this session's catalogue if need be."""
    spec = _spec(spark, path)
    if not spark.catalog.tableExists(_name(path)):
        keys = ", ".join(f"`{k}`" for k in spec["keys"])
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_name(path)} ({spec['schema']}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec['buckets']} BUCKETS LOCATION '{place}'"
        )
    spark.catalog.refreshTable(_name(path))
    return spark.table(_name(path))
