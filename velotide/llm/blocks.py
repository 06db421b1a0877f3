"""Runs of rows that Python handles together, and compact numbers to store for them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import pack, unpack

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: What a row adds to its block besides its text.
ROW_BYTES = 64
#: A key that holds more than one in so many rows is joined by broadcast; there are fewer than this.
HOT_KEYS = 1000


def blocks(batches: Iterable[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) for runs of rows of about ``size`` bytes in column ``text``.

    A number names one block within a job.
    """
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + ROW_BYTES)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = min(int(np.searchsorted(ends, before + size - n)) + 1, batch.num_rows)
            held.append(batch.slice(start, end - start))
            n += int(ends[end - 1]) - before
            start = end
            if n >= size:
                yield number, pa.Table.from_batches(held)
                number, held, n = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held)


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative 64-bit numbers, byte by byte of equal weight, compressed: small ones take little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pack(planes.tobytes())


def unpack_numbers(blob) -> np.ndarray:
    planes = np.frombuffer(unpack(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64, copy=False)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers, as their differences."""
    return pack_numbers(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob) -> np.ndarray:
    return np.cumsum(unpack_numbers(blob), dtype=np.uint64)


def parts_of(keys: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending keys, the parts (``key >> shift``) that occur and their borders."""
    part = keys >> np.uint64(shift)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
    return part[starts].astype(np.int64), np.r_[starts, len(keys)]


def with_answers(rows: DataFrame, answers: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` left-joined to ``answers``, which has one row per key and its number of rows.

    Keys that hold much of the rows get their answer by broadcast, so no task
    gathers them.  Fewer than HOT_KEYS can be so frequent.
    """
    total = answers.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) > total / HOT_KEYS
    few = F.broadcast(answers.where(hot))
    rest = rows.join(few.select(key), key, "left_anti").join(answers.where(~hot), key, "left")
    return rows.join(few, key).unionByName(rest)
