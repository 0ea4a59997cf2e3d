"""Feature extraction and the distance table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from skyledger.functions import times
from skyledger.operators.aggregates import mean_distance
from skyledger.operators.ordering import FEATURE_ORDER, sorted_files
from skyledger.schemas import TRAINING_FEATURE
from skyledger.sources import keyed
from skyledger.sources.readers import json_lines
from skyledger.sources.writers import write_json

# The columns of interest.
FEATURE_COLUMNS = ("FlightNum", "FlightDate", "DayOfWeek", "DayOfMonth", "DayOfYear", "Carrier", "Origin", "Dest",
                   "Distance", "DepDelay", "ArrDelay", "CRSDepTime", "CRSArrTime")


def selected(flights: DataFrame) -> DataFrame:
    """The 13 columns of interest, with both delays known."""
    named = flights.withColumn("DayOfYear", times.month_day(F.col("Month"), F.col("DayofMonth"))).withColumnRenamed(
        "DayofMonth", "DayOfMonth")
    return named.where("ArrDelay IS NOT NULL AND DepDelay IS NOT NULL").select(*FEATURE_COLUMNS)


def _parsed(rows: DataFrame) -> DataFrame:
    """Add the day and both clock times as numbers."""
    return rows.withColumns({
        "_day": times.iso_day(F.col("FlightDate")),
        "_departure": times.clock_minutes(F.col("CRSDepTime")),
        "_arrival": times.clock_minutes(F.col("CRSArrTime")),
    })


def _typed(parsed: DataFrame) -> DataFrame:
    """Typed dates and times from the numbers; an arrival before its departure moves to the next day."""
    day, departure, arrival = F.col("_day"), F.col("_departure"), F.col("_arrival")
    overnight = F.when(arrival < departure, F.lit(24 * 60)).otherwise(F.lit(0))
    return parsed.withColumns({
        "FlightDate": day,
        "DayOfYear": times.day_of_year(day),
        "DayOfWeek": F.col("DayOfWeek").try_cast("int"),
        "DayOfMonth": F.col("DayOfMonth").try_cast("int"),
        "CRSDepTime": times.at_minute(day, departure),
        "CRSArrTime": times.at_minute(day, arrival + overnight),
    }).drop("_day", "_departure", "_arrival")


def _complete() -> Column:
    """Conditions on the parsed numbers, so that nothing is parsed twice."""
    known = ("_day", "_departure", "_arrival")
    numbers = [F.col(name).try_cast("int").isNotNull() for name in ("DayOfWeek", "DayOfMonth")]
    return reduce(lambda left, right: left & right, [F.col(name).isNotNull() for name in known] + numbers)


def with_times(rows: DataFrame) -> DataFrame:
    """Text dates and times to typed ones; what does not parse becomes null."""
    return _typed(_parsed(rows))


def extract(flights: DataFrame) -> DataFrame:
    """Model-ready features. Rows whose date or times do not parse are left to ``rejects``."""
    return _typed(_parsed(selected(flights)).where(_complete()))


def rejects(flights: DataFrame) -> DataFrame:
    """The source rows ``extract`` cannot use although their delays are known."""
    return _parsed(selected(flights)).where(~_complete()).select(*FEATURE_COLUMNS)


def write(features: DataFrame, path: str, compression: str | None = "bzip2") -> None:
    """Sorted JSON Lines with plain dates, in several files that are in order together."""
    write_json(sorted_files(features, FEATURE_ORDER).select(*TRAINING_FEATURE.fieldNames()), path, compression)


def distances(flights: DataFrame, descending: bool = False) -> DataFrame:
    """Mean distance of every route, in order of distance."""
    by = F.col("Distance").desc() if descending else F.col("Distance").asc()
    return mean_distance(flights).orderBy(by, "Origin", "Dest")


def read(spark: SparkSession, path: str, offset_dates: bool = False) -> DataFrame:
    """Feature files with the fixed layout. ``offset_dates``: the flight date was written as an instant with a zone
    offset, so it is turned back to UTC before its day is taken."""
    if not offset_dates:
        return json_lines(spark, path, TRAINING_FEATURE)
    as_written = StructType([StructField(f.name, StringType() if f.name == "FlightDate" else f.dataType)
                             for f in TRAINING_FEATURE])
    return json_lines(spark, path, as_written).withColumn(
        "FlightDate", times.iso_instant(F.col("FlightDate")).cast("date"))


def write_distances(distances_: DataFrame, path: str) -> None:
    """Distances as JSON Lines."""
    write_json(distances_, path)


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """Distance files with the mean distance as it was computed."""
    schema = StructType([StructField("Origin", StringType()), StructField("Dest", StringType()),
                         StructField("Distance", DoubleType())])
    return json_lines(spark, path, schema)


def import_distances(spark: SparkSession, path: str, new_version: str, old_version: str | None = None) -> DataFrame:
    """Merge distance files into the keyed table at ``old_version`` and write the result to ``new_version``.

    Keys that the files do not name stay as they were. The old version is left alone, so the import may be repeated.
    """
    old = spark.read.parquet(old_version) if old_version else None
    keyed.merged_distances(old, read_distances(spark, path)).write.mode("overwrite").parquet(new_version)
    return spark.read.parquet(new_version)
