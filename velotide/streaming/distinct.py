"""Status readings kept once, on the stream.

Stations repeat a reading until they have a new one, so most payloads bring known
readings.  The state holds the keys of recent readings and lets go of them when the
watermark has passed: its size follows the stations and ``delay``, not the history.

What comes later than that is not judged any more.  ``late_readings`` finds it
among the landed payloads, for a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velotide.functions.clock import require_utc
from velotide.operators.decode import decode_status
from velotide.operators.dedup import dedup_keep_one
from velotide.operators.merge import STATUS_KEY
from velotide.streaming.ingest import _append

#: How long after a reading its repetitions may come.
DELAY = "2 hours"


def append_distinct_status(
    payloads: DataFrame, path: str, checkpoint: str, delay: str = DELAY, trigger: dict | None = None
) -> StreamingQuery:
    """As ``append_status``, with one row per station and time of reading.

    Of repeated readings the first to arrive is kept.  A reading older than the
    latest one of all stations less ``delay`` may be dropped as late; one
    without a time is.  Both are in ``late_readings``.
    """
    require_utc()
    timed = decode_status(payloads).where(F.col("utc_timestamp").isNotNull())
    once = timed.withWatermark("utc_timestamp", delay).dropDuplicatesWithinWatermark(STATUS_KEY)
    return _append(once.withColumn("utc_date", F.to_date("utc_timestamp")), path, "utc_date", checkpoint, trigger)


def late_readings(landed: DataFrame, kept: DataFrame) -> DataFrame:
    """The readings of landed payloads that the stream has not kept, one per station and time.

    ``landed`` and ``kept`` are tables of the same days (``kept`` with the days around
    them, as readings arrive after their time).  Together with ``kept`` it gives
    every reading once.
    """
    readings = decode_status(landed)
    # Keys are compared before rows are chosen, so that only what is late is sorted.
    known = kept.select(*[F.col(c).alias(f"_{c}") for c in STATUS_KEY])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in STATUS_KEY]
    return dedup_keep_one(readings.join(known, same, "left_anti"), STATUS_KEY)
