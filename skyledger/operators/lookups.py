"""Point lookups and their set-wise forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equals_all(**keys) -> Column:
    """``a = x AND b = y ..``; plain comparisons, so they reach the scan."""
    return reduce(lambda left, right: left & right, (F.col(name) == value for name, value in keys.items()))


def find_one(df: DataFrame, order_by: list[str], **keys) -> DataFrame:
    """The first row with the given key values. ``order_by`` settles ties, so reruns give the same row."""
    return df.where(equals_all(**keys)).orderBy(*order_by).limit(1)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """``find_one`` for every key at once.

    The minimum of a struct is combined on the map side, so a hot key costs one row per map task, unlike
    ``row_number``, which would sort all rows of that key in one task.
    """
    return _extreme_per_key(df, keys, order_by, F.min)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values for every key; the remaining columns settle ties."""
    return _extreme_per_key(df, keys, order_by, F.max)


def _extreme_per_key(df, keys, order_by, pick):
    rest = [name for name in df.columns if name not in keys and name not in order_by]
    chosen = pick(F.struct(*order_by, *rest)).alias("_row")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(*[F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in df.columns])


def with_total(rows: DataFrame, counted: DataFrame, name: str = "total") -> DataFrame:
    """Put the row count of ``counted`` beside every row of ``rows``.

    A scalar subquery counts in parallel; ``count(*) OVER ()`` would move every row into one task.
    """
    return rows.withColumn(name, counted.agg(F.count(F.lit(1))).scalar())


def route_day(flights: DataFrame, origin: str, dest: str, iso_date: str, ties: list[str]) -> DataFrame:
    """Flights of one route on one day by departure and arrival time, with their count."""
    hits = flights.where(equals_all(Origin=origin, Dest=dest, FlightDate=iso_date))
    return with_total(hits, hits, "flight_count").orderBy("DepTime", "ArrTime", *ties)


def preview(df: DataFrame, rows: int = 6) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)
