"""Prediction requests from raw form rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import forms, times
from skyledger.operators.joins import with_distance


def coerced(raw: DataFrame, delay_type: str = "decimal") -> DataFrame:
    """Form text to typed fields; text that does not convert becomes null."""
    convert = {"decimal": forms.to_decimal, "integer": forms.to_integer}[delay_type]
    texts = {name: F.col(name).cast("string") for name in ("Carrier", "FlightDate", "Dest", "FlightNum", "Origin")}
    return raw.withColumns({"DepDelay": convert(F.col("DepDelay").cast("string")), **texts})


def with_date_parts(rows: DataFrame, numbering: str = "iso") -> DataFrame:
    """Day of year, month and week of the flight date; null where the date does not parse."""
    day = times.iso_day(F.col("FlightDate"))
    return rows.withColumns({
        "DayOfYear": times.day_of_year(day),
        "DayOfMonth": times.day_of_month(day),
        "DayOfWeek": times.day_of_week(day, numbering),
    })


def build(raw: DataFrame, distances: DataFrame, *, numbering: str = "iso", as_of: str | Column | None = None,
          request_id: Column | None = None, missing: str = "zero", integer_distance: bool = False,
          delay_type: str = "decimal", spread: int = 1) -> DataFrame:
    """Requests ready to store or send: coerced fields, distance, date parts, request time and, if given, an id.

    Works on a table and on a stream (the distance join is then stream to table).
    """
    typed = coerced(raw, delay_type)
    located = with_distance(typed, distances, missing, integer_distance, spread)
    dated = with_date_parts(located, numbering).withColumn("Timestamp", forms.request_time(as_of))
    return dated if request_id is None else dated.withColumn("UUID", request_id)


def batch_requests(raw: DataFrame, distances: DataFrame, **options) -> DataFrame:
    """Requests of the daily path (no id)."""
    return build(raw, distances, **options)


def realtime_requests(raw: DataFrame, distances: DataFrame, request_id: Column | None = None, **options) -> DataFrame:
    """Requests of the streaming path, with a random id unless one is given."""
    return build(raw, distances, request_id=forms.random_id() if request_id is None else request_id, **options)


def regression_requests(raw: DataFrame, distances: DataFrame, **options) -> DataFrame:
    """Requests of the regression path: the delay is a whole number there."""
    return build(raw, distances, delay_type="integer", **options)
