"""Type-2 station dimension.

Only ``active_status`` is versioned.  A version is valid in the half-open
interval [start_date, end_date); an open version has no end_date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velotide import schemas
from velotide.functions import clock
from velotide.operators.dedup import assert_unique
from velotide.operators.sizing import BROADCAST_BYTES, broadcast_if_small
from velotide.sources import files, versions

DIM_COLUMNS = schemas.DIM_STATIONS.fieldNames()


def scd_current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("end_date").isNull())


def _open_beside_snapshot(dim: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Open versions (``o``) and today's snapshot (``s``), matched by station."""
    o = scd_current(dim).select(F.col("station_id").alias("ok"), F.struct(*DIM_COLUMNS).alias("o"))
    s = snapshot.select(
        F.col("station_id").alias("sk"),
        F.struct("station_id", *schemas.STATION_ATTRIBUTES, "active_status").alias("s"),
    )
    return o.join(s, o["ok"] == s["sk"], "full_outer")


def _reconciled() -> list[Column]:
    """Columns of a reconciled row: the snapshot's value, else the old one.

    A station the snapshot does not list is inactive, and so is one listed
    without a status.
    """
    return [
        F.coalesce("o.station_id", "s.station_id").alias("station_id"),
        *[F.coalesce(f"s.{c}", f"o.{c}").alias(c) for c in schemas.STATION_ATTRIBUTES],
        F.coalesce("s.active_status", F.lit(False)).alias("active_status"),
    ]


def scd_reconcile(dim: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Each station's reconciled state, with the start of its open version."""
    return _open_beside_snapshot(dim, snapshot).select(
        *_reconciled(), F.col("o.start_date").alias("start_date")
    )


def scd2_changes(
    dim: DataFrame, snapshot: DataFrame, run_date: dt.date | str, run_ts: str
) -> DataFrame:
    """All open versions after the run, and the versions the run closed.

    Unchanged status: the open version stays, and only last_updated moves (a new
    name or address is not stored).  Changed status: the open version is closed
    and a new one starts.  New station: a version starts.  One join yields all
    of them: every joined row is exploded into the version kept or closed and
    the version started.  Closed history takes no part.
    """
    day = F.lit(clock.as_date(run_date))
    now = F.lit(run_ts).cast("timestamp")

    same = F.coalesce(
        (F.col("o.active_status") == F.coalesce("s.active_status", F.lit(False)))
        & F.col("o.start_date").isNotNull(),
        F.lit(False),
    )
    old = F.when(
        F.col("o").isNotNull(),
        F.struct(
            *[F.col(f"o.{c}").alias(c) for c in DIM_COLUMNS[:-2]],
            F.when(~same, day).alias("end_date"),
            now.alias("last_updated"),
        ),
    )
    started = F.when(
        ~same,
        F.struct(
            *_reconciled(),
            day.alias("start_date"),
            F.lit(None).cast("date").alias("end_date"),
            now.alias("last_updated"),
        ),
    )
    joined = _open_beside_snapshot(dim, snapshot)
    versions = joined.select(F.explode(F.array_compact(F.array(old, started))).alias("v"))
    return versions.select("v.*")


def scd2_merge(
    dim: DataFrame, snapshot: DataFrame, run_date: dt.date | str, run_ts: str
) -> DataFrame:
    """The dimension after merging the snapshot of ``run_date``.

    Only open versions are matched, so a station that goes off and on again
    within a day keeps exactly one open version.  The snapshot must hold one row
    per station (``assert_unique``).
    """
    history = dim.filter(F.col("end_date").isNotNull()).select(*DIM_COLUMNS)
    return history.unionByName(scd2_changes(dim, snapshot, run_date, run_ts))


def scd_as_of(
    fact: DataFrame,
    dim: DataFrame,
    day: str,
    key: str = "station_id",
    columns: tuple[str, ...] = ("name", "active_status", "start_date"),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact rows with the station version valid on their date ``day``.

    Facts without a valid version keep NULLs.  The join always has the station
    as an equality key beside the date range, so it never compares all pairs.
    """
    wanted = dict.fromkeys(["station_id", "start_date", "end_date", *columns])
    d = broadcast_if_small(dim.select(*wanted), broadcast_bytes).alias("d")
    f = fact.alias("f")
    valid = (
        (F.col(f"f.{key}") == F.col("d.station_id"))
        & (F.col("d.start_date") <= F.col(f"f.{day}"))
        & (F.col("d.end_date").isNull() | (F.col(f"f.{day}") < F.col("d.end_date")))
    )
    return f.join(d, valid, "left").select("f.*", *[F.col(f"d.{c}") for c in columns])


def scd_as_of_sorted(
    fact: DataFrame,
    dim: DataFrame,
    day: str,
    key: str = "station_id",
    columns: tuple[str, ...] = ("name", "active_status", "start_date"),
) -> DataFrame:
    """``scd_as_of`` without a join: for dimensions with very many versions per station.

    Versions and facts are laid out together by station and day, and the last
    version that has started is carried forward.  A fact meets one version,
    however many its station has, while the join compares it with all of them.

    A station is cut by month, so that a hot one, or one with long history, is no
    single task; a version is sent to the months in which it holds, up to the
    last fact's.  Versions of a station must not overlap; those without a day are passed over.
    """
    first, last = (fact.select(f(day)).scalar() for f in (F.min, F.max))
    until = F.least(F.coalesce(F.date_sub("end_date", 1), last), last)
    since = F.greatest(F.col("start_date"), first)
    versions_ = dim.where("station_id IS NOT NULL AND start_date IS NOT NULL").where(since <= until).select(
        F.col("station_id").alias("_key"),
        F.explode(F.sequence(F.trunc(since, "MM"), F.trunc(until, "MM"), F.expr("interval 1 month"))).alias("_month"),
        F.col("start_date").alias("_at"),
        F.struct(*dict.fromkeys(["end_date", *columns])).alias("_version"),
        F.lit(None).cast(fact.select(F.struct("*")).schema[0].dataType).alias("_fact"),
    )
    facts = fact.select(
        F.col(key).alias("_key"), F.trunc(day, "MM").alias("_month"), F.col(day).alias("_at"),
        F.lit(None).cast(versions_.schema["_version"].dataType).alias("_version"), F.struct("*").alias("_fact"),
    )
    # Of one day, the version comes before the facts.
    order = Window.partitionBy("_key", "_month").orderBy("_at", F.col("_fact").isNotNull())
    carried = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = versions_.unionByName(facts).withColumn("_valid", carried).where(F.col("_fact").isNotNull())
    ended = F.col("_valid.end_date") <= F.col("_at")
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull() & ~F.coalesce(ended, F.lit(False))
    return rows.select("_fact.*", *[F.when(known, F.col("_valid")[c]).alias(c) for c in columns])


# -- the stored dimension ------------------------------------------------------
#
# open-<name> holds all open versions after a run, closed-<name> the versions a
# run closed.  The pointer (``versions``) names the last finished run, its open
# folder and the closed folders that belong to it, and the same for the run
# before, from which the last one may be run again.  A run writes new folders
# and then moves the pointer; what no run refers to any more is dropped.

# Beyond this number of closed folders the smallest of them are merged into one, so
# that neither the pointer nor a listing grows with the number of runs.  Long history
# is left alone until the others have grown to its size: a row is written again about
# as often as the history has grown twelvefold.
CLOSED_FOLDERS, MERGED_FOLDERS = 16, 12
FILE_BYTES = 128 * 1024 * 1024


class LateRunError(ValueError):
    """A run is older than the last one merged."""


def _instant(run_ts: str) -> dt.datetime:
    """The run time as an instant; without an offset it is UTC."""
    at = dt.datetime.fromisoformat(run_ts)
    return at.replace(tzinfo=dt.UTC) if at.tzinfo is None else at.astimezone(dt.UTC)


def _versions_of(spark: SparkSession, path: str, state: dict | None) -> DataFrame:
    folders = [] if state is None else [f"{path}/{n}" for n in (state["open"], *state["closed"])]
    if not folders:
        return spark.createDataFrame([], schemas.DIM_STATIONS)
    return spark.read.schema(schemas.DIM_STATIONS).parquet(*folders)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """The stored dimension after its last finished run."""
    return _versions_of(spark, path, versions.state(spark, path))


def is_late(spark: SparkSession, path: str, run_ts: str) -> bool:
    """Whether a run is older than the last one merged."""
    last = versions.state(spark, path)
    return last is not None and _instant(run_ts) < dt.datetime.fromisoformat(last["run"])


def apply_snapshot(
    snapshot: DataFrame, path: str, run_date: dt.date | str, run_ts: str
) -> None:
    """Merge a snapshot into the stored dimension.

    Runs go forward in time.  The last run may be run again, which replaces what
    it did; an older one raises ``LateRunError``, as the runs after it were
    merged without it (``history.put_in_late`` puts it in).  Raises, naming the stations, if the snapshot lists a
    station twice.
    """
    spark = snapshot.sparkSession
    assert_unique(snapshot, ["station_id"])
    at = _instant(run_ts)
    last = versions.state(spark, path)
    if is_late(spark, path, run_ts):
        raise LateRunError(f"the run of {run_ts} comes after that of {last['run']}")
    again = last is not None and at == dt.datetime.fromisoformat(last["run"])
    before = last["before"] if again else last

    name = versions.fresh_name()
    new = {
        "run": at.isoformat(),
        "date": clock.as_date(run_date).isoformat(),
        "open": f"open-{name}",
        "closed": [f"closed-{name}"],
    }
    dim = _versions_of(spark, path, before and {**before, "closed": []})
    changed = scd2_changes(dim, snapshot, run_date, at.isoformat())
    # Both folders come from one computation: a station's change opens and closes.
    changed.withColumn("is_current", F.col("end_date").isNull()).write.partitionBy(
        "is_current"
    ).parquet(f"{path}/run-{name}")
    for part, folder in (("true", new["open"]), ("false", new["closed"][0])):
        source = f"{path}/run-{name}/is_current={part}"
        if files.exists(spark, source):
            files.move(spark, source, f"{path}/{folder}")
        else:
            spark.createDataFrame([], schemas.DIM_STATIONS).write.parquet(f"{path}/{folder}")

    if before:
        new["closed"] = [*before["closed"], *new["closed"]]
        before = {**before, "before": None}
    if len(new["closed"]) > CLOSED_FOLDERS:
        size = {c: files.total_bytes(spark, f"{path}/{c}") for c in new["closed"]}
        small = sorted(new["closed"], key=lambda c: (size[c], c))[:MERGED_FOLDERS]
        closed = spark.read.schema(schemas.DIM_STATIONS).parquet(*[f"{path}/{c}" for c in small])
        closed.coalesce(1 + sum(size[c] for c in small) // FILE_BYTES).write.parquet(f"{path}/closed-all-{name}")
        new["closed"] = [*[c for c in new["closed"] if c not in small], f"closed-all-{name}"]
    kept = {f for s in (new, before) if s for f in (s["open"], *s["closed"])}
    versions.point(spark, path, {**new, "before": before}, kept)
