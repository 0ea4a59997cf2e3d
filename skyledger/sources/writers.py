"""Batch writers. All of them write from the executors and may be rerun."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.messages import render

Sink = Callable[[DataFrame, int], None]


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON Lines."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def json_to_parquet(spark: SparkSession, source: str, target: str, schema=None) -> DataFrame:
    """Convert JSON Lines to Parquet; without a schema it is inferred."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    write_parquet(reader.json(source), target)
    return spark.read.parquet(target)


def replace_day(df: DataFrame, base: str, iso_date: str) -> None:
    """Replace one day's directory, also when the new content is empty."""
    df.drop("dt").write.mode("overwrite").json(f"{base}/dt={iso_date}")


def replace_days(df: DataFrame, base: str) -> None:
    """Replace every day that occurs in the ``dt`` column and leave the other days alone.

    The rebalance hint gathers the rows of a day into few files and splits a day that is much larger than the others.
    """
    (df.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").json(base))


def append(df: DataFrame, fmt: str, options: dict[str, str] | None = None, path: str | None = None) -> None:
    """Append to a table of any installed connector."""
    writer = df.write.format(fmt).options(**(options or {})).mode("append")
    writer.save(path) if path else writer.save()


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], columns: list[str] | None = None) -> tuple[int, dict[str, int]]:
    """Run ``write`` on ``df`` and return the number of rows it wrote and the nulls of every column.

    The counts are taken while rows pass to the write, so nothing is read again to learn them, nor to know whether a write was empty.
    """
    columns = df.columns if columns is None else columns
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(name).isNull()).alias(f"null_{place}") for place, name in enumerate(columns)]))
    return seen.get["rows"], {name: seen.get[f"null_{place}"] for place, name in enumerate(columns)}


def as_messages(df: DataFrame) -> DataFrame:
    """Every row as one JSON text in a ``value`` column."""
    return df.select(render(*df.columns).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str, fmt: str = "kafka") -> None:
    """Send every row as a JSON message."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    as_messages(df).write.format(fmt).options(**options).mode("append").save()


# --- sinks of a micro-batch -------------------------------------------------------------------------------------------

def message_log(path: str) -> Sink:
    """JSON messages in one directory per batch; a replayed batch replaces its own directory."""
    def write(batch: DataFrame, batch_id: int) -> None:
        as_messages(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def row_log(path: str) -> Sink:
    """Rows in one directory per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def topic_sink(servers: str, topic: str) -> Sink:
    """JSON messages to a topic. A replayed batch is sent again; readers keep the latest per id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(batch, servers, topic)
    return write
