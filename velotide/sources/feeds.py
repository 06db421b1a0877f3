"""Batch readers of the station, weather and trip feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide import schemas
from velotide.functions import clock, values
from velotide.functions.keys import SUFFIX_LENGTH, station_key_suffix

# -- station info --------------------------------------------------------------


class StationDocumentError(ValueError):
    """A station document cannot be read, or an entry lacks a field."""


def read_station_documents(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """The JSON documents at ``path``, as text.

    One document per file, or one per line with ``whole_files=False``, which
    lets Spark split large files.
    """
    return spark.read.text(path, wholetext=whole_files)


def read_station_info(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Station entries (nested, as sent) of the JSON documents at ``path``."""
    return station_entries(read_station_documents(spark, path, whole_files))


def _stations() -> Column:
    parsed = F.from_json(F.col("value").cast("string"), schemas.STATION_INFO_PAYLOAD)
    return parsed["data"]["stations"]


def station_entries(documents: DataFrame) -> DataFrame:
    """Station entries, nested, as sent; a document that cannot be read has none."""
    return documents.select(F.explode(_stations()).alias("s"))


def undecodable(documents: DataFrame) -> DataFrame:
    """Documents without a readable list of stations."""
    return documents.filter(_stations().isNull())


def assert_complete(documents: DataFrame, show: int = 20) -> None:
    """Raise if a document cannot be read, there is none, or an entry lacks a field.

    A station that is missing from a snapshot counts as closed.  A feed that is
    broken in part must therefore not be taken for a snapshot at all.
    """
    count, bad = documents.agg(F.count("*"), F.count_if(_stations().isNull())).first()
    if bad or not count:
        raise StationDocumentError(f"{bad} of {count} station documents cannot be read")
    rejects = [r.asDict() for r in station_rejects(station_entries(documents)).limit(show).collect()]
    if rejects:
        raise StationDocumentError(f"station entries that lack a field: {rejects}")


def _is_complete_entry() -> Column:
    complete = F.col("s").isNotNull()
    for field in ("station_id", "name", "lon", "lat", "_bcycle_station_type", "address"):
        complete = complete & F.col(f"s.{field}").isNotNull()
    return complete


def station_rows(entries: DataFrame, key_length: int = SUFFIX_LENGTH) -> DataFrame:
    """Snapshot rows.  A station listed in the feed counts as active.

    Its key is the last ``key_length`` characters of its id.
    """
    return entries.filter(_is_complete_entry()).select(
        station_key_suffix(F.col("s.station_id"), key_length).alias("station_id"),
        F.col("s.name").alias("name"),
        F.col("s.lon").alias("lon"),
        F.col("s.lat").alias("lat"),
        F.col("s._bcycle_station_type").alias("station_type"),
        F.col("s.address").alias("address"),
        F.lit(True).alias("active_status"),
    )


def station_rejects(entries: DataFrame) -> DataFrame:
    """Entries that lack a required field, as sent."""
    return entries.filter(~_is_complete_entry()).select("s.*")


# -- weather -------------------------------------------------------------------

_WEATHER_SERIES = [c for c in schemas.WEATHER_COLUMNS if c != "date"]


def weather_rows(reports: DataFrame) -> DataFrame:
    """One row per step of each report's half-open time axis [start, end).

    A report holds ``start`` and ``end`` (epoch seconds), ``interval_s`` and one
    array per series.  NaN, the feed's word for unknown, becomes NULL.  Arrays
    that do not fit the axis fail the query: padding them would silently move
    values to other hours.
    """
    axis = F.when(
        F.col("start") < F.col("end"),
        F.sequence("start", F.col("end") - 1, F.col("interval_s").cast("bigint")),
    ).otherwise(F.array().cast("array<bigint>"))

    fits = F.lit(True)
    for name in _WEATHER_SERIES:
        fits = fits & F.coalesce(F.size(name) == F.size("axis"), F.lit(False))
    checked = F.when(fits, F.col("axis")).otherwise(
        F.raise_error(
            F.concat(F.lit("weather arrays do not fit the time axis of the report at "),
                     F.col("start").cast("string"))
        )
    )
    # Only the axis is exploded; each series is then read at the step's position,
    # which builds no struct per step.
    steps = reports.withColumn("axis", axis).select(
        F.posexplode(checked).alias("step", "at"), *_WEATHER_SERIES
    )
    series = {name: F.get(name, F.col("step")) for name in _WEATHER_SERIES}
    return steps.select(
        clock.iso_utc(clock.epoch_to_utc(F.col("at"))).alias("date"),
        values.number(series["temperature_2m"]).alias("temperature_2m"),
        values.whole_number(series["relative_humidity_2m"]).alias("relative_humidity_2m"),
        values.number(series["rain"]).alias("rain"),
        values.number(series["snowfall"]).alias("snowfall"),
        values.whole_number(series["cloud_cover"]).alias("cloud_cover"),
    )


# -- trips ---------------------------------------------------------------------


def read_trips(
    spark: SparkSession,
    path: str,
    mode: str = "FAILFAST",
    timestamp_format: str | None = None,
) -> DataFrame:
    """Quarterly trip files with a header line; ``path`` may hold globs.

    The schema is declared, so no file is read twice to guess types, and the
    header of every file is checked against it.  A bad value fails the query (or
    drops the line, with ``DROPMALFORMED``).  Spark judges a line by the columns
    a query reads, so load whole rows, as the trip fact does, before analysing.
    """
    reader = spark.read.schema(schemas.TRIP_CSV).options(
        header=True, enforceSchema=False, mode=mode
    )
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


#: Columns that ``read_trip_lines`` adds.
BAD_LINE, FILE = "bad_line", "file"


def read_trip_lines(spark: SparkSession, path: str, timestamp_format: str | None = None) -> DataFrame:
    """All lines of the quarterly files, with their ``file`` and, where they don't fit, ``bad_line``.

    A line with too few or too many columns, or with a value that is not of its
    column's type, is kept as text; its other columns hold what could be read.
    Store the rows before choosing among them: Spark judges a line by the columns
    a query reads.
    """
    reader = spark.read.schema(f"{schemas.TRIP_CSV}, {BAD_LINE} string").options(
        header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE
    )
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path).withColumn(FILE, F.col("_metadata.file_path"))


def _is_trip() -> Column:
    """Whether a line fits its columns and its trip_id is a number, as the fact's key is."""
    numbered = F.col("trip_id").isNull() | F.col("trip_id").try_cast("bigint").isNotNull()
    return F.col(BAD_LINE).isNull() & numbered


def good_trips(lines: DataFrame) -> DataFrame:
    """The trips of stored ``read_trip_lines``."""
    return lines.where(_is_trip()).drop(BAD_LINE, FILE)


def trip_rejects(lines: DataFrame) -> DataFrame:
    """(file, line) of the lines that are no trip; one that only lacks a whole number as its id is
    written anew from its values."""
    values_ = F.to_csv(F.struct(*[c for c in lines.columns if c not in (BAD_LINE, FILE)]))
    return lines.where(~_is_trip()).select(FILE, F.coalesce(BAD_LINE, values_).alias("line"))
