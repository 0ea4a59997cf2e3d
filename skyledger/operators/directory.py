"""Order directories: rows in a fixed order, found by their place in it.

A table is written in ranges of its order, one sorted file each. The directory beside it has a row per range: its file, how many rows
it holds and how many lie before it. A page at any depth, by number, then reads and sorts the range it lies in; a filtered page
counts hits per range, which reads the filter's columns and sorts nothing, and then seeks the same way. Places are exact.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE, PLACE = "_range", "_place"  # number of the range, and of the row in it from 0
ROWS_PER_RANGE = 1 << 20


def sort_keys(order: tuple[str, ...]) -> list[Column]:
    """Ascending, missing values last."""
    return [F.col(name).asc_nulls_last() for name in order]


def write_ordered(df: DataFrame, path: str, order: tuple[str, ...], rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Write ``df`` in order below ``path``, with its directory. ``order`` must tell rows apart, or equal rows stay in one range.

    The number of ranges follows from the number of rows. A row's range and place are the numbers Spark gives the rows of a
    sorted partition; they are written with it.
    """
    ranges = max(1, math.ceil(df.count() / rows_per_range))
    ordered = df.repartitionByRange(ranges, *sort_keys(order)).sortWithinPartitions(*sort_keys(order))
    number = F.monotonically_increasing_id()
    ordered.select("*", F.shiftright(number, 33).cast("int").alias(RANGE), number.bitwiseAND((1 << 33) - 1).alias(PLACE)
                   ).write.mode("overwrite").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    counts = rows.groupBy(RANGE, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    with_before(counts).write.mode("overwrite").parquet(f"{path}/directory")


def with_before(counts: DataFrame) -> DataFrame:
    """Add ``before``, the rows of all earlier ranges. One row per range: a table of the ranges, not of the rows."""
    earlier = W.orderBy(RANGE, "file").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their range and place."""
    return spark.read.parquet(f"{path}/rows")


def directory_of(spark: SparkSession, path: str, condition: Column | None = None) -> DataFrame:
    """``(_range, file, rows, before)``: of all rows as written, or of those that meet ``condition``, counted per range."""
    if condition is None:
        return spark.read.parquet(f"{path}/directory")
    hits = rows_of(spark, path).where(condition)
    return with_before(hits.groupBy(RANGE, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows")))


def page(spark: SparkSession, path: str, order: tuple[str, ...], start: int, size: int, condition: Column | None = None) -> DataFrame:
    """Rows ``start`` to ``start + size`` of the order, or of the hits of ``condition`` in it, with their ``position`` from 1.

    Only the ranges of the page are listed and read; the directory says which. Without a condition their rows know their place,
    with one the hits in them are sorted. As many entries come to the driver as ranges have rows of the page.
    """
    touched = directory_of(spark, path, condition).where(
        (F.col("before") < start + size) & (F.col("before") + F.col("rows") > start)).orderBy("before").collect()
    everything = rows_of(spark, path)
    if not touched:
        return everything.where(F.lit(False)).drop(RANGE, PLACE).withColumn("position", F.lit(None).cast("long"))
    found = spark.read.schema(everything.schema).parquet(*[f"{path}/rows/{entry.file}" for entry in touched])
    if condition is None:  # places are known, so nothing is sorted
        position = reduce(lambda rest, entry: F.when(F.col(RANGE) == entry[RANGE], F.col(PLACE) + (entry.before + 1)).otherwise(rest),
                          touched, F.lit(None).cast("long"))
        hits = found.where((F.col(PLACE) >= start - touched[0].before) | (F.col(RANGE) != touched[0][RANGE]))
        return hits.withColumn("position", position).where(F.col("position").between(start + 1, start + size)).drop(RANGE, PLACE)
    top = found.where(condition).orderBy(*sort_keys(order)).limit(start - touched[0].before + size)
    rank = F.row_number().over(W.orderBy(*sort_keys(order))) + touched[0].before
    return top.withColumn("position", rank.cast("long")).where(F.col("position") > start).drop(RANGE, PLACE)


def positions(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their ``position`` from 1 in the whole order: an offset per range, no sort."""
    offsets = directory_of(spark, path).select(RANGE, "before")
    return rows_of(spark, path).join(offsets, RANGE).withColumn("position", F.col("before") + F.col(PLACE) + 1).drop(RANGE, PLACE, "before")


def pages(spark: SparkSession, path: str, requests: DataFrame, size: int, id_col: str = "request", start_col: str = "start") -> DataFrame:
    """The rows of many pages at once: ``(request, start, position, *columns)``. A page behind the end has no rows.

    Two equi-joins: a position finds its range by the block of positions they share, a block being as long as the longest range, so
    that a range lies in two blocks at most; then range and place find the row.
    """
    asked = requests.select(F.col(id_col).alias("_request"), F.greatest(F.col(start_col).cast("long"), F.lit(0).cast("long")).alias("_start"))
    wanted = asked.select("_request", "_start", F.explode(F.sequence("_start", F.col("_start") + (size - 1))).alias("_at"))
    listed = directory_of(spark, path)
    block = listed.agg(F.max("rows")).first()[0] or 1
    of_block = lambda place: F.floor(place / block)
    last = F.col("before") + F.col("rows") - 1
    ranges = listed.select(F.col(RANGE).alias("_in"), "before", "rows", F.explode(F.sequence(of_block(F.col("before")), of_block(last))).alias("_block"))
    placed = wanted.withColumn("_block", of_block(F.col("_at"))).join(ranges, "_block").where((F.col("before") <= F.col("_at")) & (F.col("_at") <= last))
    rows = rows_of(spark, path)
    joined = placed.join(rows, (F.col("_in") == F.col(RANGE)) & (F.col("_at") - F.col("before") == F.col(PLACE)))
    shown = [name for name in rows.columns if name not in (RANGE, PLACE)]
    return joined.select(F.col("_request").alias(id_col), F.col("_start").alias(start_col), (F.col("_at") + 1).alias("position"), *shown)


def write_numbered(df: DataFrame, path: str, keys: tuple[str, ...], order: tuple[str, ...], rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Write ``df`` by ``keys`` and ``order`` for ``numbered``, with the part that every key has in each range."""
    write_ordered(df, path, (*keys, *order), rows_per_range)
    parts = rows_of(df.sparkSession, path).groupBy(*keys, RANGE).agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    parts.select(*keys, RANGE, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_add"),
                 F.sum("_rows").over(W.partitionBy(*keys)).alias("_of")).write.mode("overwrite").parquet(f"{path}/parts")


def numbered(spark: SparkSession, path: str, keys: list[str], name: str = "position") -> DataFrame:
    """The rows with their place among those of the same keys, from 1, and the number of these as ``<name>_of``.

    Like ``row_number`` and ``count`` over the keys, but a key that a third of all rows have is spread over ranges instead of being
    sorted by one task: a row's place is that in its range plus the rows of its key in earlier ranges.
    """
    parts = spark.read.parquet(f"{path}/parts").select(*[F.col(key).alias(f"_key_{key}") for key in keys], F.col(RANGE).alias("_part"), "_add", "_of")
    same = F.col(RANGE) == F.col("_part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    rows = rows_of(spark, path)
    shown = [column for column in rows.columns if column not in (RANGE, PLACE)]
    return rows.join(parts, same).select(*shown, (F.col(PLACE) + F.col("_add")).alias(name), F.col("_of").alias(f"{name}_of"))
