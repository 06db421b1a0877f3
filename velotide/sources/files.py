"""Paths on whatever file system the session uses, through Spark's own client."""

from __future__ import annotations

import atexit
import datetime as dt
import re
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

_own_bases: dict[str, str] = {}
_scratch: list[tuple[SparkSession, str]] = []


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Spark job has committed its output there."""
    return exists(spark, f"{path}/_SUCCESS")


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, jpath = _path(spark, path)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below ``path``."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def day_folders(
    spark: SparkSession, path: str, column: str, first: dt.date, last: dt.date
) -> list[str]:
    """Folders ``<column>=<date>`` below ``path`` with a date in [first, last].

    Reading these paths lists the files of those days only.  Reading the table
    and filtering would list every file of its history first.
    """
    wanted = []
    for name in subdirectories(spark, path):
        key, _, value = name.partition("=")
        if key == column and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
            if first <= dt.date.fromisoformat(value) <= last:
                wanted.append(f"{path}/{name}")
    return wanted


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if there is none."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; readers see the old content or the new, never part of it."""
    fs, temporary = _path(spark, f"{path}-{uuid.uuid4().hex}")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    target = fs.makeQualified(hadoop.Path(path))
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(temporary), target, options)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.mkdirs(jpath)


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, jpath = _path(spark, path)
    if not fs.rename(jpath, _path(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def delete(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.delete(jpath, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory path in the shared folder of the cluster.

    That is ``spark.checkpoint.dir``.  Where it is unset, a local session gets a
    folder of its own; a cluster must name one, because executors could not see
    a folder on one machine.  What is stored there is dropped when the process
    ends, as results are read from it until then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _own_base(spark)
    path = f"{base.rstrip('/')}/velotide/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def _own_base(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors see")
    if context.applicationId not in _own_bases:
        _own_bases[context.applicationId] = tempfile.mkdtemp(prefix="velotide-")
    return _own_bases[context.applicationId]


@atexit.register
def drop_scratch() -> None:
    """Delete what ``scratch_dir`` has handed out, and the folders made for it."""
    while _scratch:
        spark, path = _scratch.pop()
        if SparkContext._active_spark_context is spark.sparkContext:
            delete(spark, path)
    while _own_bases:
        shutil.rmtree(_own_bases.popitem()[1], ignore_errors=True)
