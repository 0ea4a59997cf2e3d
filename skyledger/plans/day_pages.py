"""Page tables kept up to date by day.

What a page needs is kept as one mergeable state per day: counts, which are added up, distinct pairs, which are united, and sketches
of distinct tail numbers, which are merged. A day that arrives, is corrected or becomes empty replaces its own state and touches
nothing else; pages are merged from the states, which are far smaller than the flights.

States lie by month. An update rewrites the months of its days: the days it does not name stay as they are. Where there are states
it is written aside first. It is moved in by Spark's dynamic partition overwrite, so it may be repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import work_folder

DAY, PERIOD = "dt", "period"
SKETCH_BITS = 12


def sketch_error(bits: int = SKETCH_BITS, deviations: float = 3.0) -> float:
    """Relative error that an estimate of distinct values stays within, for so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << bits)


def day_states(flights: DataFrame) -> dict[str, DataFrame]:
    """The state of every day in ``flights`` by table; each combines on the map side and has ``dt`` and ``period``."""
    day = flights.withColumn(DAY, F.col("FlightDate").cast("date")).withColumn(PERIOD, F.date_format(DAY, "yyyy-MM"))
    rows = F.count(F.lit(1)).alias("rows")
    # A sketch leaves out nulls, and empty texts too, unless something stands before them.
    return {
        "months": day.groupBy(PERIOD, DAY, "Year", "Month").agg(rows),
        "airplanes": day.groupBy(PERIOD, DAY, "TailNum").agg(rows),
        "fleets": day.select(PERIOD, DAY, "Carrier", "TailNum").distinct(),
        "sketches": day.groupBy(PERIOD, DAY, "Carrier").agg(F.hll_sketch_agg(F.concat(F.lit("#"), "TailNum"), F.lit(SKETCH_BITS)).alias("tails")),
    }


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def update(spark: SparkSession, base: str, flights: DataFrame, days: DataFrame | None = None) -> None:
    """Replace the states of days below ``base``. ``days`` lists them as ``dt``; by default the days that ``flights`` has.

    A listed day without flights loses its state. Flights of days that are not listed are left out.
    """
    named = flights.select(F.col("FlightDate").cast("date").alias(DAY)) if days is None else days.select(F.col(DAY).cast("date").alias(DAY))
    aside = work_folder(spark, "day-states")
    named.where(f"{DAY} IS NOT NULL").distinct().withColumn(PERIOD, F.date_format(DAY, "yyyy-MM")).write.parquet(f"{aside}/days")
    replaced = spark.read.parquet(f"{aside}/days")
    periods = replaced.select(PERIOD).distinct()
    chosen = flights.join(replaced.select(F.col(DAY).alias("_day")), F.col("FlightDate").cast("date") == F.col("_day"), "left_semi")
    chosen.select("FlightDate", "Year", "Month", "Carrier", "TailNum").write.parquet(f"{aside}/flights")  # read once per table below
    for name, made in day_states(spark.read.parquet(f"{aside}/flights")).items():
        rows, target = made, f"{base}/{name}"
        if _exists(spark, target):
            old = spark.read.schema(made.schema).parquet(target)
            kept = old.join(periods, PERIOD, "left_semi").join(replaced.select(DAY), DAY, "left_anti")
            # What is overwritten is not read meanwhile. Where there is no state yet, nothing is, and the new one need not be written twice.
            made.unionByName(kept.select(*made.columns)).write.parquet(f"{aside}/{name}")
            rows = spark.read.schema(made.schema).parquet(f"{aside}/{name}")
        # A month that has lost all its rows is overwritten too, by one row without a day, which merging leaves out.
        markers = periods.select(*[F.col(PERIOD) if c == PERIOD else F.lit(None).cast(made.schema[c].dataType).alias(c) for c in made.columns])
        (rows.unionByName(markers).hint("rebalance", PERIOD)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(target))


def states(spark: SparkSession, base: str, name: str, when: Column | None = None) -> DataFrame:
    """The states of a table; ``when``, a condition on ``period`` and ``dt``, prunes months."""
    rows = spark.read.parquet(f"{base}/{name}").where(F.col(DAY).isNotNull())
    return rows if when is None else rows.where(when)


def flights_by_month(spark: SparkSession, base: str) -> DataFrame:
    return states(spark, base, "months").groupBy("Year", "Month").agg(F.sum("rows").alias("total_flights"))


def flights_per_airplane(spark: SparkSession, base: str) -> DataFrame:
    """``(TailNum, FlightCount)``; null is a key."""
    return states(spark, base, "airplanes").groupBy("TailNum").agg(F.sum("rows").alias("FlightCount"))


def fleet_counts(spark: SparkSession, base: str) -> DataFrame:
    """``(Carrier, FleetCount)``: distinct known tail numbers, exact."""
    return states(spark, base, "fleets").select("Carrier", "TailNum").distinct().groupBy("Carrier").agg(F.count("TailNum").alias("FleetCount"))


def fleet_estimates(spark: SparkSession, base: str, when: Column | None = None) -> DataFrame:
    """``(Carrier, estimate)``: distinct known tail numbers from the sketches, for any days without looking at pairs.

    The relative error is within ``sketch_error()``; small fleets are counted exactly.
    """
    return states(spark, base, "sketches", when).groupBy("Carrier").agg(F.hll_sketch_estimate(F.hll_union_agg("tails")).alias("estimate"))
