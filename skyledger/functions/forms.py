"""Form-field coercion and request identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.times import iso_text

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


def to_integer(text: Column) -> Column:
    """Whole-number text to int; anything else, decimals included, gives null."""
    return F.when(text.rlike(_INTEGER), F.trim(text).try_cast("int"))


def to_decimal(text: Column) -> Column:
    """Number text to double; anything else gives null."""
    return F.when(text.rlike(_DECIMAL), F.trim(text).try_cast("double"))


def random_id() -> Column:
    """A random UUID per row."""
    return F.uuid()


def replayable_id(*keys: Column) -> Column:
    """An id derived from the key columns, equal on every replay. Nulls and separators cannot collide."""
    return F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)


def request_time(as_of: str | Column | None = None) -> Column:
    """Request time as ISO text: now, or the given instant."""
    if as_of is None:
        return iso_text(F.current_timestamp())
    if isinstance(as_of, str):
        return F.lit(as_of)
    return iso_text(as_of)


def hash_bucket(key: Column, buckets: Column | int) -> Column:
    """A bucket in ``0 .. buckets-1`` from the first 32 bits of the key's MD5.

    The bucket depends on the key only, never on the partitioning, and any SQL engine can recompute it.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return number % (F.lit(buckets) if isinstance(buckets, int) else buckets).cast("bigint")
