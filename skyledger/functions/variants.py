"""Documents without a common schema.

A document is parsed once into a variant, a binary form that keeps its own fields and types; files hold it as it is, and fields are
taken by path when they are asked for. Documents of one column may differ in every field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """A JSON text as a variant; null where it is no JSON."""
    return F.try_parse_json(text)


def rejected(df: DataFrame, text: str, document: str) -> DataFrame:
    """The rows whose text is there but is no JSON."""
    return df.where(F.col(text).isNotNull() & F.col(document).isNull())


def taken(document: Column, path: str, kind: str) -> Column:
    """The value at ``path`` (``$.a.b``, ``$.list[0]``) as ``kind``; null where it is missing or cannot be such a value."""
    return F.try_variant_get(document, path, kind)


def required(document: Column, path: str, kind: str) -> Column:
    """Like ``taken``, but a value that is there and cannot be of ``kind`` fails the job."""
    return F.variant_get(document, path, kind)


def has(document: Column, path: str) -> Column:
    """Whether there is a value at ``path``, an explicit null included."""
    return F.coalesce(F.try_variant_get(document, path, "variant").isNotNull(), F.lit(False))


def merged_schema(df: DataFrame, document: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """One schema that holds all documents (of every key), as text, found in one pass that combines on the map side."""
    return df.groupBy(*keys).agg(F.schema_of_variant_agg(document).alias("schema"))


def fields(df: DataFrame, document: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, field, value)``: the top-level fields of every document as rows; documents that are no objects have none.

    An explicit null is a field; its ``value`` is a variant that holds null.
    """
    df.createOrReplaceTempView("_variant_documents")
    kept = "".join(f"d.`{name}`, " for name in keep)
    return df.sparkSession.sql(
        f"SELECT {kept}f.key AS field, f.value AS value FROM _variant_documents d, LATERAL variant_explode(d.`{document}`) f WHERE f.key IS NOT NULL")
