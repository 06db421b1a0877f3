"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and their bytes, from one distributed pass.

    Text counts by its length, a value of fixed size by that; nested values by
    their JSON form.
    """
    size = F.lit(0)
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            column = F.octet_length(column)
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            column = F.octet_length(F.to_json(F.struct(column)))
        else:
            column = F.lit(8)
        size = size + F.coalesce(column, F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def broadcast_if_small(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Mark ``df`` for broadcast when it measures small, else return it as is.

    Unmarked, the join shuffles both sides by key, and run-time skew handling
    splits the partition of a key that holds much of the fact.  Pass only the
    columns the join needs: they are what is measured and sent.
    """
    rows, size = measured(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
