"""JSON messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def as_text(value: Column) -> Column:
    """Message bytes to text."""
    return value.cast("string")


def parse(value: Column, schema: StructType) -> Column:
    """JSON bytes or text to a struct; malformed input gives a struct of nulls."""
    return F.from_json(as_text(value), schema)


def render(*columns: str | Column) -> Column:
    """Columns to one JSON text; null fields are left out."""
    return F.to_json(F.struct(*columns))
