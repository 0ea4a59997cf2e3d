"""The pre-aggregated tables that pages and charts read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.operators import aggregates, documents

# The key that readers filter each table by.
KEYS = {"flights_by_month": ["Year", "Month"], "airplane_manufacturer_totals": [], "flights_per_airplane": ["TailNum"],
        "airplanes_per_carrier": ["Carrier"]}


def collections(flights: DataFrame, airplanes: DataFrame) -> dict[str, DataFrame]:
    """Every page table by name."""
    totals = aggregates.manufacturer_totals(airplanes)
    return {
        "flights_by_month": aggregates.flights_by_month(flights),
        "airplane_manufacturer_totals": documents.chart(totals, "Manufacturer", "Total"),
        "flights_per_airplane": documents.flights_per_airplane(flights),
        "airplanes_per_carrier": documents.fleet_per_carrier(flights),
    }


def write(made: dict[str, DataFrame], base: str) -> None:
    """Write page tables below ``base``, one folder each.

    Files are dealt by ranges of the key and of the whole row, which splits a hot key, and sorted, so that a reader of one key
    skips most of them. A table without a key keeps its own order.
    """
    for name, table in made.items():
        key = KEYS.get(name, [])
        if key:
            rest = [column for column in table.columns if column not in key]
            table = table.repartitionByRange(*key, *rest).sortWithinPartitions(*key, *rest)
        table.write.mode("overwrite").parquet(f"{base}/{name}")
