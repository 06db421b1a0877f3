"""Are stations used efficiently?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.sources import tables, versions


def station_utilisation(trips: DataFrame) -> DataFrame:
    """Trips out and in, their total and the net flow (in - out) per station.

    Each trip becomes two rows inside the scan's stage and is counted before the
    shuffle, so a busy station sends one row per task and both directions need
    one pass.  A trip end without station is left out.
    """
    ends = trips.select(
        F.explode(
            F.array(
                F.struct(F.col("start_station").alias("station_id"), F.lit(1).alias("out"), F.lit(0).alias("in")),
                F.struct(F.col("end_station").alias("station_id"), F.lit(0).alias("out"), F.lit(1).alias("in")),
            )
        ).alias("e")
    ).select("e.*")
    moved = ends.filter(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        F.sum("out").alias("trips_out"), F.sum("in").alias("trips_in")
    )
    return moved.select(
        "station_id",
        "trips_out",
        "trips_in",
        (F.col("trips_out") + F.col("trips_in")).alias("total"),
        (F.col("trips_in") - F.col("trips_out")).alias("net_flow"),
    )


def utilisation_tier(
    utilisation: DataFrame, low: float = 0.1, high: float = 0.9
) -> DataFrame:
    """Add ``tier``: over (total at or above the high percentile), under, normal.

    The percentiles are exact and interpolated.  They are taken over the distinct
    totals weighted by how many stations share them: D distinct totals add up to
    at least D(D-1)/2 trip ends, so even 10^12 trips leave at most some two
    million values for the final aggregate, whatever the number of stations.
    """
    spread = utilisation.groupBy("total").agg(F.count(F.lit(1)).alias("stations"))
    cuts = spread.agg(
        F.percentile("total", F.array(F.lit(low), F.lit(high)), F.col("stations")).alias("cuts")
    )
    cut = cuts.select("cuts").scalar()
    return utilisation.withColumn(
        "tier",
        F.when(F.col("total") >= cut[1], "over")
        .when(F.col("total") <= cut[0], "under")
        .otherwise("normal"),
    )


def busiest_stations(utilisation: DataFrame, k: int) -> DataFrame:
    """The ``k`` stations with the highest total; the smaller key wins a tie."""
    return utilisation.orderBy(F.desc("total"), F.asc("station_id")).limit(k)


# -- kept up to date -----------------------------------------------------------
#
# The tiers above need every trip again when trips are added.  Here each load (a day)
# leaves its stations' totals and a sketch of them, and sketches of all loads merge:
# a station's load is judged against the loads of all stations so far.

#: Size of a sketch: ranks are off by some 0.1 % at most times (0.6 % at k = 512).
SKETCH = 4096
#: Folders below a table's path.
TOTALS, SKETCHES = "totals", "sketches"


def load_station_totals(trips: DataFrame, path: str, load_id: str) -> None:
    """Add the totals of a load of trips per station, and the sketch of these totals.

    Reads the new trips only.  The same ``load_id`` again replaces its rows.
    """
    spark = trips.sparkSession
    totals = station_utilisation(trips).select("station_id", "total")
    tables.load(totals, f"{path}/{TOTALS}", tables.APPEND, load_id=load_id)
    stored = versions.read(spark, f"{path}/{TOTALS}").where(F.col("load_id").cast("string") == load_id)
    sketch = stored.agg(F.kll_sketch_agg_bigint("total", F.lit(SKETCH)).alias("sketch"), F.count(F.lit(1)).alias("stations"))
    tables.load(sketch.where("stations > 0"), f"{path}/{SKETCHES}", tables.APPEND, load_id=load_id)


def stored_cuts(spark: SparkSession, path: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """One row (low, high): about those percentiles of the totals of all loads, from one sketch a load."""
    sketches = versions.read(spark, f"{path}/{SKETCHES}")
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("s"))
    return merged.select(*[F.kll_sketch_get_quantile_bigint("s", F.lit(q)).alias(n) for n, q in (("low", low), ("high", high))])


def load_tiers(spark: SparkSession, path: str, load_id: str | None = None) -> DataFrame:
    """(load_id, station_id, total, tier) of one load's stations, or of all loads'.

    As ``utilisation_tier``: over at or above the high cut, under at or below the low one.
    """
    totals = versions.read(spark, f"{path}/{TOTALS}").withColumn("load_id", F.col("load_id").cast("string"))
    if load_id is not None:
        totals = totals.where(F.col("load_id") == load_id)
    cuts = stored_cuts(spark, path)
    low, high = (cuts.select(c).scalar() for c in ("low", "high"))
    tier = F.when(F.col("total") >= high, "over").when(F.col("total") <= low, "under").otherwise("normal")
    return totals.select("load_id", "station_id", "total", tier.alias("tier"))
