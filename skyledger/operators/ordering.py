"""Sorting and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.forms import hash_bucket

# Sort keys of the feature files.
FEATURE_ORDER = ("DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime")


def sorted_files(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Rows split into ranges of the sort keys and sorted inside each: the written files are in order one after another.

    A hash of the row follows the sort keys, so many rows with equal keys do not end up in one range.
    """
    return df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)


def hash_sample(df: DataFrame, key: Column, one_in: int, seed: str = "") -> DataFrame:
    """Keep about one in ``one_in`` rows, chosen by the key alone.

    The choice is the same on every partitioning and rerun, and later filters still reach the scan.
    """
    if seed:
        key = F.concat_ws(":", F.lit(seed), key.cast("string"))
    return df.where(hash_bucket(key, one_in) == 0)


def split_by_key(df: DataFrame, key: Column, one_in: int) -> tuple[DataFrame, DataFrame]:
    """Training rows and about one in ``one_in`` held-out rows; all rows with one key are on the same side."""
    bucket = hash_bucket(key, one_in)
    return df.where(bucket != 0), df.where(bucket == 0)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Seeded row sample without replacement; the chosen rows depend on the partitioning."""
    return df.sample(False, fraction, seed)


def top_by(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """First rows of an order; each task keeps ``rows`` rows at most."""
    return df.orderBy(*order).limit(rows)
