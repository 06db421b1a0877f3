"""Registration of queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, *reads: str, oracle: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame that reads tables ``reads``.

    Its plan runs under the caller's settings for shuffles.
    """

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return register


def table_path(sf_dir: str, table: str) -> str:
    return f"{sf_dir}/{table}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of files.

    A plain path has to be a folder; a pattern (the braces) may also name a file.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 10_000)
    return reader.parquet(table_path(sf_dir, f"{{{name}}}"))


def comparable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, which collect the same in any zone."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in instants}) if instants else df


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages cut to ten digits: the order in which doubles are summed varies."""
    return df.withColumns({c: F.round(c, 10) for c in columns})
