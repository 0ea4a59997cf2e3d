"""Dates, scheduled times and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def clock_text(hhmm: Column) -> Column:
    """``HHMM`` text to ``HH:MM:00``; hour 24 becomes 23:59. Text without an hour gives null."""
    hour = F.substring(hhmm, F.lit(1), F.length(hhmm) - 2)
    minute = F.right(hhmm, F.lit(2))
    clock = F.when(hour == "24", F.lit("23:59")).otherwise(F.concat_ws(":", hour, minute))
    return F.when(F.length(hhmm) > 2, F.concat(clock, F.lit(":00")))


def clock_minutes(hhmm: Column) -> Column:
    """``HHMM`` text to minutes after midnight; hour 24 becomes 23:59. Null when it is no time.

    The hour stands for 100 in the text and for 60 in the result, hence the 40 to take off. Integer arithmetic keeps the
    generated code small enough for the JIT compiler; text put together and parsed again does not.
    """
    number = F.when(F.length(hhmm).between(3, 4), hhmm.try_cast("int"))
    valid = (number >= 0) & (number < 2500) & ((number % 100 < 60) | (number >= 2400))
    return F.when(valid, F.least(number - F.floor(number / 100) * 40, F.lit(23 * 60 + 59)))


def at_minute(day: Column, minutes: Column) -> Column:
    """Date and minutes after midnight to a UTC timestamp, whatever the session zone."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86_400 + minutes * 60)


def scheduled_at(iso_date: Column, hhmm: Column) -> Column:
    """Date text and ``HHMM`` text to a UTC timestamp; null when either part is not valid."""
    return at_minute(iso_day(iso_date), clock_minutes(hhmm))


def next_day_if_before(arrival: Column, departure: Column) -> Column:
    """An arrival that is earlier than its departure belongs to the following day."""
    return F.when(arrival < departure, arrival + F.expr("INTERVAL 1 DAY")).otherwise(arrival)


def iso_day(text: Column) -> Column:
    """ISO date or timestamp text to a date; null when it does not parse."""
    return text.try_cast("date")


def iso_instant(text: Column) -> Column:
    """ISO timestamp text to a timestamp; null when it does not parse."""
    return text.try_cast("timestamp")


def iso_text(instant: Column) -> Column:
    """Timestamp to ISO text with microseconds and no zone."""
    return F.date_format(instant, ISO_MICROS)


def day_of_year(day: Column) -> Column:
    return F.dayofyear(day)


def day_of_month(day: Column) -> Column:
    return F.dayofmonth(day)


def day_of_week(day: Column, numbering: str = "iso") -> Column:
    """``iso``: Monday = 1 .. Sunday = 7, as in the training data. ``weekday0``: Monday = 0 .. Sunday = 6."""
    if numbering == "iso":
        return F.weekday(day) + 1
    if numbering == "weekday0":
        return F.weekday(day)
    raise ValueError(f"unknown day-of-week numbering: {numbering}")


def month_day(month: Column, day: Column) -> Column:
    """``Month-Day`` label; null when either part is null."""
    return F.concat(month.cast("string"), F.lit("-"), day.cast("string"))


def within_day(instant: Column, iso_date: str) -> Column:
    """Half-open day range on timestamps."""
    start = F.lit(iso_date).cast("date")
    return (instant >= start.cast("timestamp")) & (instant < F.date_add(start, 1).cast("timestamp"))


def within_day_text(text: Column, iso_date: str) -> Column:
    """Day range on ISO text, compared as text with both ends included (a bare next-day date also matches)."""
    start = F.lit(iso_date).cast("date")
    return (text >= start.cast("string")) & (text <= F.date_add(start, 1).cast("string"))
