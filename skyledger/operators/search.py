"""Filtered, sorted, paged search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.text import matches
from skyledger.operators.lookups import with_total

# Rows per result page and sort keys of both searches.
PAGE_SIZE = 10
FLIGHT_ORDER = ("FlightDate", "DepTime", "Carrier", "FlightNum")
AIRPLANE_ORDER = ("Owner",)


def criteria(filters: dict[str, str | None], fields: tuple[str, ...], words: tuple[str, ...] = ()) -> Column:
    """All given filters joined with AND; an absent or empty filter adds nothing.

    A filter is compared with ``=``, which reaches the scan. Fields in ``words`` hold free text: they match when they share a
    word with the filter, in any case, and have to be read to be judged.
    """
    unknown = set(filters) - set(fields)
    if unknown:
        raise ValueError(f"no such search fields: {sorted(unknown)}")
    parts = [
        matches(F.col(name), value) if name in words else F.col(name) == value
        for name, value in filters.items() if value
    ]
    return reduce(lambda left, right: left & right, parts, F.lit(True))


def order_columns(df: DataFrame, order: tuple[str, ...], ties: tuple[str, ...]) -> list[Column]:
    """Ascending sort keys, missing values last; names the table does not have are ignored."""
    return [F.col(name).asc_nulls_last() for name in (*order, *ties) if name in df.columns]


def search(df: DataFrame, condition: Column, order: tuple[str, ...], ties: tuple[str, ...], start: int = 0,
           size: int = PAGE_SIZE, count_name: str = "hit_count") -> DataFrame:
    """One page of hits with the total number of hits.

    The page is a top-k: each task, and the one that merges them, keeps ``start + size`` rows at most. It is meant for the first
    pages; deeper ones are reached by ``page_after``, whose cost does not grow with the depth. The total is a separate
    parallel count that reads the filter columns only.
    """
    hits = df.where(condition)
    page = hits.orderBy(*order_columns(df, order, ties)).offset(start).limit(size)
    return with_total(page, hits, count_name)


def flight_search(flights: DataFrame, filters: dict[str, str | None], fields: tuple[str, ...],
                  ties: tuple[str, ...] = (), words: tuple[str, ...] = (), **page) -> DataFrame:
    return search(flights, criteria(filters, fields, words), FLIGHT_ORDER, ties, count_name="flight_count", **page)


def airplane_search(airplanes: DataFrame, filters: dict[str, str | None], fields: tuple[str, ...],
                    ties: tuple[str, ...] = (), words: tuple[str, ...] = (), **page) -> DataFrame:
    return search(airplanes, criteria(filters, fields, words), AIRPLANE_ORDER, ties, count_name="airplane_count",
                  **page)


def page_after(df: DataFrame, condition: Column, order: tuple[str, ...], last: tuple, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows the row with the sort values ``last``.

    Unlike ``offset`` this does not sort the pages before it. ``order`` must identify a row and hold no nulls.
    """
    if len(order) != len(last):
        raise ValueError("one value per sort key is needed")
    after, same = F.lit(False), F.lit(True)
    for name, value in zip(order, last):
        after = after | (same & (F.col(name) > value))
        same = same & (F.col(name) == value)
    return df.where(condition & after).orderBy(*order).limit(size)
