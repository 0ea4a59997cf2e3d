"""Keyed tables with last-write-wins.

What is latest is told by the rows themselves: the greatest time in the message wins, and of equal times the greatest remaining
columns. Taking the latest is therefore the same in any order, any number of times and in any grouping. A stream only appends, every
micro-batch to a place of its own, named by the query that wrote it and its batch number; batches sent again, a second writer,
late answers and an interrupted ``compact`` leave the same table. ``compact`` folds all places into one, so that a read does not
grow with the number of micro-batches.

Imports without a time of their own go through ``merged``, where the newer import wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.lookups import latest_per_key

COMPACTED = "compacted"  # the writer of folded places

# Columns of the response table in its order, as name in a message and type in the table.
RESPONSE_FIELDS = {
    "UUID": "string", "Origin": "string", "Dest": "string", "Carrier": "string", "DepDelay": "double",
    "Prediction": "double", "Timestamp": "string", "FlightDate": "string", "DayOfWeek": "int", "DayOfYear": "int",
    "DayOfMonth": "int", "Distance": "double", "Route": "string",
}
RESPONSE_KEY, RESPONSE_ORDER = ["uuid"], ["timestamp"]
DISTANCE_KEY = ["origin", "dest"]


def merged(old: DataFrame | None, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of every key: new rows win over old ones, ``order`` settles several new rows of a key."""
    rows = new.withColumn("_turn", F.lit(1))
    if old is not None:
        rows = old.select(*new.columns).withColumn("_turn", F.lit(0)).unionByName(rows)
    return latest_per_key(rows, keys, ["_turn", *order]).drop("_turn")


def combined(tables: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of every key by ``order``, then by the remaining columns; the same for any order of ``tables``."""
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table.select(*rows.columns))
    return latest_per_key(rows, keys, order)


def append(rows: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Add the rows of one write. The same writer and batch replace their own earlier attempt and nothing else."""
    rows.write.mode("overwrite").parquet(f"{path}/writer={writer}/batch={batch_id}")


def latest(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of every key over all writes, by ``order`` and then by the remaining columns."""
    return combined([spark.read.parquet(path).drop("writer", "batch")], keys, order)


def places(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Writer and batch of every place below ``path``; listed from the folders, no row is read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop(f"{path}/writer=*/batch=*"))
    names = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found]
    return sorted((writer.removeprefix("writer="), int(batch.removeprefix("batch="))) for writer, batch in names)


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> None:
    """Fold all places into one.

    The folded place is written first; the places it covers go afterwards. Between the two a row stands twice, which changes nothing,
    so a run that breaks off loses nothing and the next one cleans up. Batches written meanwhile are not touched. A reader that
    began before may miss files it has listed; it starts again.
    """
    covered = places(spark, path)
    generation = max((batch for writer, batch in covered if writer == COMPACTED), default=-1) + 1
    rows = spark.read.parquet(*[f"{path}/writer={writer}/batch={batch}" for writer, batch in covered])
    append(combined([rows], keys, order), path, COMPACTED, generation)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for writer, batch in covered:
        files.delete(hadoop(f"{path}/writer={writer}/batch={batch}"), True)


def state_table(spark: SparkSession, checkpoint: str, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key out of the state of ``streaming.jobs.latest_answers``: one row per key and window, no writes are read."""
    state = spark.read.format("statestore").load(checkpoint)
    row = state.schema["value"].dataType.names[0]
    return combined([state.select(f"value.{row}.*")], keys, order)


def response_rows(scored: DataFrame) -> DataFrame:
    """Scored requests in the layout of the response table: 13 lower-case columns."""
    return scored.select(*[F.col(name).cast(kind).alias(name.lower()) for name, kind in RESPONSE_FIELDS.items()])


def responses(spark: SparkSession, path: str) -> DataFrame:
    """The latest response per ``uuid``, by the time in it."""
    return latest(spark, path, RESPONSE_KEY, RESPONSE_ORDER)


def distance_rows(distances: DataFrame) -> DataFrame:
    """Distances in the layout of the keyed table: lower-case names, distance truncated to int."""
    return distances.select(F.col("Origin").alias("origin"), F.col("Dest").alias("dest"),
                            F.col("Distance").cast("int").alias("distance"))


def merged_distances(old: DataFrame | None, distances: DataFrame) -> DataFrame:
    """The keyed distance table with ``distances`` merged in; of several lines with one key the longest distance stays."""
    return merged(old, distance_rows(distances), DISTANCE_KEY, ["distance"])
