"""Keyed tables that are joined where they lie.

A table is written in buckets of its key, one sorted file per bucket. A join on the key then moves only the other side, to the same
buckets; the table is neither exchanged nor sorted again. Two tables with the same buckets are joined without any exchange.
Definitions live in the session's catalogue and point to the folder; ``opened`` puts one there again in a new session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Each bucket is a single file, so Spark may rely on the order inside it.
KEEPS_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
DEAL = "deal"


def write(df: DataFrame, path: str, name: str, keys: list[str], buckets: int, spread: int = 1) -> DataFrame:
    """Write ``df`` to ``buckets`` buckets of ``keys`` and return the table.

    Rows are dealt by the same hash that bucketing uses, so a task writes one bucket, in one file. With ``spread`` every row is
    written that many times with a number in ``deal``, which becomes part of the key: rows that join it are dealt over the copies,
    so that a key which a third of them have meets ``spread`` buckets (``joined``).
    """
    if spread > 1:
        df, keys = df.withColumn(DEAL, F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))), [*keys, DEAL]
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


def opened(spark: SparkSession, path: str, name: str, schema: str, keys: list[str], buckets: int) -> DataFrame:
    """The table at ``path``, defined anew where the session's catalogue does not know it. ``schema`` is its layout as SQL text."""
    listed = ", ".join(f"`{key}`" for key in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def joined(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``rows`` with the columns of a bucketed ``table`` by ``keys``; the table stays where it is, whatever its size.

    The hint asks for the merge join that uses buckets and order as they lie. It replaces no broadcast that would be needed: a
    table that is small enough for one has few and small buckets.
    """
    rows.sparkSession.conf.set(KEEPS_ORDER, "true")
    if DEAL in table.columns:
        copies = table.agg(F.max(DEAL)).first()[0] + 1
        dealt = rows.withColumn(DEAL, F.pmod(F.xxhash64(*rows.columns), F.lit(copies)).cast("int"))
        return dealt.join(table.hint("merge"), [*keys, DEAL], how).drop(DEAL)
    return rows.join(table.hint("merge"), keys, how)
