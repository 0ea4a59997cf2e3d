"""From message bytes to request rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.messages import as_text, parse
from skyledger.schemas import INDEX_FIELDS, STREAM_MESSAGE

# Fields a request keeps after parsing; flight number and a sent class are left out.
REQUEST_FIELDS = ("Origin", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest", "DepDelay", "Timestamp", "FlightDate",
                  "Carrier", "UUID", "Distance")


def parsed(messages: DataFrame, schema: StructType = STREAM_MESSAGE) -> DataFrame:
    """Message text as ``value`` and its fields as the struct ``flight``."""
    return messages.select(as_text(F.col("value")).alias("value"), parse(F.col("value"), schema).alias("flight"))


def requests(parsed_: DataFrame, with_indices: bool = False) -> DataFrame:
    """The flat request fields of messages that carry an id; ``with_indices`` adds the indices the sender computed."""
    names = REQUEST_FIELDS + (INDEX_FIELDS if with_indices else ())
    return parsed_.where("flight.UUID IS NOT NULL").select(*[F.col(f"flight.{name}") for name in names])


def rejects(parsed_: DataFrame) -> DataFrame:
    """The text of messages without an id: malformed, or not a request."""
    return parsed_.where("flight.UUID IS NULL").select("value")
