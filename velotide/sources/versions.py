"""Tables that are replaced as a whole.

Each state of a table is a folder of its own below the table's path; a small
file beside them names the current one.  A state is written in full before the
name moves, so a load that fails leaves the old rows, and readers never meet a
half-written table.  The state before the current one is kept for readers that
have started on it; older ones are dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from velotide.sources import files

# Spark passes over names that start with an underscore.
POINTER = "_current"


def state(spark: SparkSession, path: str) -> dict | None:
    """What the pointer of the table at ``path`` says; None before the first state."""
    text = files.read_text(spark, f"{path}/{POINTER}")
    return json.loads(text) if text else None


def point(spark: SparkSession, path: str, new: dict, keep: set[str]) -> None:
    """Make ``new`` the state, in one step; then drop all folders but ``keep``."""
    files.replace_text(spark, f"{path}/{POINTER}", json.dumps(new))
    for name in files.subdirectories(spark, path):
        if name not in keep:
            files.delete(spark, f"{path}/{name}")


def fresh_name() -> str:
    return f"state-{uuid.uuid4().hex}"


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current state."""
    now = state(spark, path)
    return f"{path}/{now['folder']}" if now else None


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Write a new state with ``write`` (given its folder) and make it current."""
    before = state(spark, path) or {}
    name = fresh_name()
    write(f"{path}/{name}")
    point(spark, path, {"folder": name}, {name, before.get("folder")})
    return f"{path}/{name}"


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current rows of the table at ``path``."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(folder)
