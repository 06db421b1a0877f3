"""Loading tables: dispositions, schema hints, full rebuilds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.sources import versions

# The dispositions.
TRUNCATE = "WRITE_TRUNCATE"
APPEND = "WRITE_APPEND"
EMPTY = "WRITE_EMPTY"

# Logical name -> (table name, columns whose type is not inferred).
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "stations_info": (
        "stg_stations",
        {
            "station_id": "string",
            "name": "string",
            "station_type": "string",
            "address": "string",
            "active_status": "boolean",
        },
    ),
    "stations_status": (
        "stations_status",
        {"utc_timestamp": "timestamp", "station_id": "string"},
    ),
    "weather": ("stg_weather", {"date": "string"}),
}


class TableNotEmptyError(RuntimeError):
    """An EMPTY load met a table that already holds rows."""


def table_name(logical: str) -> str:
    return _spec(logical)[0]


def _spec(logical: str) -> tuple[str, dict[str, str]]:
    if logical not in TABLES:
        raise KeyError(f"no table is known as {logical!r}; known: {sorted(TABLES)}")
    return TABLES[logical]


def apply_schema_hints(df: DataFrame, logical: str) -> DataFrame:
    """Cast the hinted columns; the others keep the type they came with."""
    name, hints = _spec(logical)
    missing = [column for column in hints if column not in df.columns]
    if missing:
        raise ValueError(f"{name} needs the columns {missing}")
    return df.withColumns({c: F.col(c).cast(t) for c, t in hints.items()})


def has_rows(spark: SparkSession, path: str) -> bool:
    """Reads at most one row; a table that was never loaded holds none."""
    if versions.current(spark, path) is None:
        return False
    return not versions.read(spark, path).isEmpty()


def load(
    df: DataFrame,
    path: str,
    disposition: str = TRUNCATE,
    partition_by: Sequence[str] = (),
    load_id: str | None = None,
) -> None:
    """Write ``df`` to the table at ``path``.

    TRUNCATE replaces the content, APPEND adds to it, EMPTY writes only where the
    table holds no rows and raises otherwise.  A failed write raises, and the
    table stays as it was (``versions``).  ``read_table`` reads it.

    An appending load with a ``load_id`` owns the folder ``load_id=<id>``: when
    the job is run again after a failure it replaces its own rows and adds no
    second copy.
    """
    spark = df.sparkSession
    if disposition not in (TRUNCATE, APPEND, EMPTY):
        raise ValueError(f"unknown disposition {disposition!r}")
    if disposition == EMPTY and has_rows(spark, path):
        raise TableNotEmptyError(path)

    if load_id is not None and disposition != APPEND:
        raise ValueError("load_id goes with APPEND only")
    folder = versions.current(spark, path)
    if disposition != APPEND or folder is None:
        folder = versions.replace(
            spark, path, lambda new: write_partitioned(df, _owned(new, load_id), "overwrite", partition_by)
        )
    elif load_id is not None:
        write_partitioned(df, _owned(folder, load_id), "overwrite", partition_by)
    else:
        write_partitioned(df, folder, "append", partition_by)


def _owned(folder: str, load_id: str | None) -> str:
    return folder if load_id is None else f"{folder}/load_id={load_id}"


def load_table(
    df: DataFrame, base: str, logical: str, disposition: str = TRUNCATE, **options
) -> str:
    """Apply the schema hints and load into the table's folder below ``base``."""
    path = f"{base}/{table_name(logical)}"
    load(apply_schema_hints(df, logical), path, disposition, **options)
    return path


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the whole table with ``df`` and read it back."""
    spark = df.sparkSession
    versions.replace(spark, path, lambda new: write_partitioned(df, new, "overwrite", partition_by))
    return versions.read(spark, path, df.schema)


def read_table(spark: SparkSession, base: str, logical: str) -> DataFrame:
    """The rows of a table that ``load_table`` keeps below ``base``."""
    return versions.read(spark, f"{base}/{table_name(logical)}")


def write_partitioned(
    df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = ()
) -> None:
    """Write Parquet; with ``partition_by``, in folders by those columns.

    Without a shuffle every task would write one small file per folder.  The
    rebalancing shuffle gathers a folder's rows into files of a sensible size,
    and a folder that takes much of the data is split over tasks at run time.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
