"""The type-2 dimension from dated snapshots, in one pass: gaps and islands.

Merging snapshot after snapshot gives the same versions, but needs the days in
order.  Here a station's statuses are laid out by day: listed days are events, and
the first day of each gap is one, too (inactive).  Runs of equal status are islands;
each is a version, from its first day to the first of the next.  So a day that
comes late can be put in at its place, and only the stations whose status it
changes are derived again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velotide import schemas
from velotide.functions.clock import as_date
from velotide.operators.dedup import assert_unique
from velotide.operators.scd import DIM_COLUMNS, LateRunError, read_stations
from velotide.sources import files, snapshots, versions

DAY = "snapshot_date"


def days_table(spark: SparkSession, days: dict[dt.date, str]) -> DataFrame:
    """One row per snapshot day: its number and run time, and the day after it."""
    order = sorted(days)
    rows = [
        (day, k, days[day], order[k] if k < len(order) else None)
        for k, day in enumerate(order, 1)
    ]
    table = spark.createDataFrame(rows, f"{DAY} date, k int, run_ts string, next_day date")
    return table.withColumn("run_ts", F.col("run_ts").cast("timestamp"))


def versions_of(
    listed: DataFrame, days: dict[dt.date, str], opened: DataFrame | None = None
) -> DataFrame:
    """All versions after merging the snapshots of ``days``, whatever order they came in.

    ``listed``: the stations of all snapshots, with their day in ``snapshot_date``,
    one row per station and day.  ``days``: the run time of each day; a day without
    stations counts, too.  ``opened``: versions open before the first day; each
    goes on as its station's first.

    A station has at most one row a day, so no window holds more than there are
    days, and all windows share one shuffle by station.  The days are as few as
    snapshots are kept, and travel with the plan.
    """
    spark = listed.sparkSession
    if not days:
        return opened if opened is not None else spark.createDataFrame([], schemas.DIM_STATIONS)
    attributes = F.struct(*schemas.STATION_ATTRIBUTES).alias("attributes")
    events = listed.join(F.broadcast(days_table(spark, days)), DAY).select(
        "station_id", "k", F.col(DAY).alias("day"), "next_day",
        F.coalesce("active_status", F.lit(False)).alias("active"), attributes,
    )
    if opened is not None:
        # An open version without status or start equals none: the first day starts anew.
        known = F.when(F.col("start_date").isNotNull(), F.col("active_status"))
        events = events.unionByName(
            opened.select(
                "station_id", F.lit(0).alias("k"), F.col("start_date").alias("day"),
                F.lit(min(days)).alias("next_day"), known.alias("active"), attributes,
                F.col("active_status").alias("stored"),
            ),
            allowMissingColumns=True,
        )
    else:
        events = events.withColumn("stored", F.lit(None).cast("boolean"))

    in_time = Window.partitionBy("station_id").orderBy("k")
    event = F.struct("k", "day", "active", F.coalesce("active", "stored").alias("status"), "attributes")
    none = F.lit(None).cast(listed.select(attributes).schema[0].dataType)
    gap = F.struct(
        (F.col("k") + 1).alias("k"), F.col("next_day").alias("day"), F.lit(False).alias("active"),
        F.lit(False).alias("status"), none.alias("attributes"),
    )
    after = F.lead("k").over(in_time)
    in_gap = F.col("next_day").isNotNull() & (F.coalesce(after, F.lit(0)) != F.col("k") + 1)
    events = events.withColumn("in_gap", in_gap).select(
        "station_id", F.explode(F.array_compact(F.array(event, F.when(F.col("in_gap"), gap)))).alias("e")
    ).select("station_id", "e.*")

    before = F.lag("active").over(in_time)
    first = F.row_number().over(in_time) == 1
    starts = events.withColumn("starts", first | ~before.eqNullSafe(F.col("active"))).where("starts")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, 0)
    stored = [
        F.last(F.col("attributes")[c], ignorenulls=True).over(so_far).alias(c) for c in schemas.STATION_ATTRIBUTES
    ]
    out = starts.select(
        "station_id", *stored, F.col("status").alias("active_status"), F.col("day").alias("start_date"),
        F.lead("day").over(in_time).alias("end_date"),
    )
    closed = F.broadcast(days_table(spark, days).select(F.col(DAY).alias("end_date"), "run_ts"))
    out = out.join(closed, "end_date", "left")
    last = F.lit(days[max(days)]).cast("timestamp")
    return out.withColumn("last_updated", F.coalesce("run_ts", last)).select(*DIM_COLUMNS)


# -- a day put in late -----------------------------------------------------------


def read_snapshots(spark: SparkSession, base: str) -> tuple[DataFrame, list[dt.date]]:
    """Stations of all finished dated snapshots below ``base`` with their day, and the days."""
    days = sorted(
        as_date(name.removeprefix(snapshots.SNAPSHOT_PREFIX))
        for name in files.subdirectories(spark, base)
        if name.startswith(snapshots.SNAPSHOT_PREFIX) and files.is_complete(spark, f"{base}/{name}")
    )
    columns = ["station_id", *schemas.STATION_ATTRIBUTES, "active_status"]
    schema = ", ".join(f"{c} {schemas.DIM_STATIONS[c].dataType.simpleString()}" for c in columns)
    if not days:
        return spark.createDataFrame([], f"{schema}, {DAY} date"), days
    folders = [f"{base}/{snapshots.SNAPSHOT_PREFIX}{day.isoformat()}" for day in days]
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(folders)
    found = F.regexp_extract("_metadata.file_path", rf"{snapshots.SNAPSHOT_PREFIX}(\d{{4}}-\d{{2}}-\d{{2}})", 1)
    return rows.select("*", found.cast("date").alias(DAY)), days


def as_of(dim: DataFrame, day: dt.date) -> DataFrame:
    """The versions valid on ``day``, as they were open then."""
    valid = dim.where((F.col("start_date") <= F.lit(day)) & (F.col("end_date").isNull() | (F.col("end_date") > F.lit(day))))
    return valid.withColumn("end_date", F.lit(None).cast("date"))


def affected(dim: DataFrame, late: DataFrame, day: dt.date) -> DataFrame:
    """The stations whose versions a snapshot of ``day`` changes, if put into ``dim``."""
    before = as_of(dim, day).select(
        "station_id", F.col("active_status").alias("was"), F.lit(True).alias("known")
    )
    now = late.select("station_id", F.coalesce("active_status", F.lit(False)).alias("now"), F.lit(True).alias("listed"))
    both = before.join(now, "station_id", "full_outer")
    new = F.col("known").isNull()
    other = ~F.col("was").eqNullSafe(F.coalesce("now", F.lit(False)))
    return both.where(new | other).select("station_id")


def put_in_late(spark: SparkSession, path: str, base: str, run_date: dt.date | str, run_ts: str) -> None:
    """Put the stored snapshot of ``run_date`` into the stored dimension at ``path``.

    The snapshots below ``base`` of that day and all later run days must be kept; as
    they expire by age, an earlier one that is still there proves it, or that the
    dimension starts after the day.  Otherwise raises ``LateRunError``.

    Versions of the stations that the day changes are derived again from the day
    on, and bear ``run_ts``; those of all others stay.  The last run stays the last, and
    can still be run again.
    """
    day = as_date(run_date)
    state = versions.state(spark, path)
    listed, days = read_snapshots(spark, base)
    dim = read_stations(spark, path)
    if day not in days:
        raise FileNotFoundError(f"no snapshot of {day} below {base}")
    first = dim.agg(F.min("start_date")).first()[0]
    if state is None or (min(days) >= day and first is not None and first < day):
        raise LateRunError(f"snapshots since {day} are not known to be complete")
    late = listed.where(F.col(DAY) == F.lit(day))
    assert_unique(late, ["station_id"])

    name = versions.fresh_name()
    folder = f"{path}/late-{name}"
    affected(dim, late, day).write.parquet(f"{folder}-stations")
    stations = spark.read.schema("station_id string").parquet(f"{folder}-stations")
    later = {d: run_ts for d in days if d >= day}
    ours = dim.join(stations, "station_id", "left_semi")
    opened = as_of(ours, day - dt.timedelta(days=1))
    past = ours.where(F.col("end_date") < F.lit(day))
    derived = versions_of(listed.where(F.col(DAY) >= F.lit(day)).join(stations, "station_id", "left_semi"), later, opened)
    kept = dim.join(stations, "station_id", "left_anti")
    new = kept.unionByName(past.select(*DIM_COLUMNS)).unionByName(derived)

    # Beside the new state, the one before the last run: without what that run started, and
    # with what it closed still open.
    last = F.lit(as_date(state.get("date") or state["run"][:10]))
    ended = F.col("end_date").isNotNull()
    parts = {
        "open": ~ended,
        "old": ended & (F.col("end_date") < last),
        "last": ended & (F.col("end_date") >= last),
        "before": (F.col("start_date") < last) & (~ended | (F.col("end_date") >= last)),
    }
    part = F.explode(F.array_compact(F.array(*[F.when(where, name) for name, where in parts.items()])))
    rows = new.withColumn("part", part)
    rows = rows.withColumn("end_date", F.when(F.col("part") != "before", F.col("end_date")))
    rows.write.partitionBy("part").parquet(folder)
    target = {"open": f"open-{name}", "old": f"closed-{name}", "last": f"closed-last-{name}", "before": f"open-before-{name}"}
    for part, to in target.items():
        if files.exists(spark, f"{folder}/part={part}"):
            files.move(spark, f"{folder}/part={part}", f"{path}/{to}")
        else:
            spark.createDataFrame([], schemas.DIM_STATIONS).write.parquet(f"{path}/{to}")
    before = {**state, "open": target["before"], "closed": [target["old"]], "before": None}
    after = {**state, "open": target["open"], "closed": [target["old"], target["last"]], "before": before}
    versions.point(spark, path, after, set(target.values()))
