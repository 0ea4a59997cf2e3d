"""Tables behind the pages: what belongs to a key, one flat row per element.

A key may hold a third of a very large table, so nothing is gathered into one value: a table has the same shape for a tiny and
for a huge key. Counts are combined on the map side and joined; a hot key is split by the adaptive planner. A reader groups
rows by filtering on the key; writers sort files by it (``plans.pages``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a page shows of a flight.
FLIGHT_FIELDS = ("Carrier", "FlightDate", "FlightNum", "Origin", "Dest")


def with_key_count(df: DataFrame, key: str, count_name: str) -> DataFrame:
    """Every row with the number of rows of its key; null is a key."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(count_name))
    return df.join(sizes, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def flights_per_airplane(flights: DataFrame) -> DataFrame:
    """``(TailNum, FlightCount, Carrier, FlightDate, FlightNum, Origin, Dest)``, one row per flight."""
    return with_key_count(flights.select("TailNum", *FLIGHT_FIELDS), "TailNum", "FlightCount").select(
        "TailNum", "FlightCount", *FLIGHT_FIELDS)


def fleet_counts(flights: DataFrame) -> DataFrame:
    """``(Carrier, FleetCount)``: distinct known tail numbers; 0 for a carrier of which none is known."""
    return flights.select("Carrier", "TailNum").distinct().groupBy("Carrier").agg(F.count("TailNum").alias("FleetCount"))


def fleet_per_carrier(flights: DataFrame) -> DataFrame:
    """``(Carrier, FleetCount, TailNum)``, one row per distinct tail number. A carrier without known ones has one row."""
    fleet = flights.select("Carrier", "TailNum").where("TailNum IS NOT NULL").distinct()
    counts = fleet_counts(flights).withColumnRenamed("Carrier", "_carrier")
    joined = counts.join(fleet, F.col("_carrier").eqNullSafe(F.col("Carrier")), "left")
    return joined.select(F.col("_carrier").alias("Carrier"), "FleetCount", "TailNum")


def carriers(fleet: DataFrame) -> DataFrame:
    """Every carrier once."""
    return fleet.select("Carrier").distinct()


def chart(totals: DataFrame, label: str, value: str) -> DataFrame:
    """Chart rows ``(label, value)``, largest value first, equal values by label."""
    return totals.select(label, value).orderBy(F.col(value).desc(), F.col(label).asc())
