"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.messages import parse


def parquet_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A Parquet table, also registered as a temporary view."""
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(view)
    return table


def json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None,
               sampling_ratio: float | None = None) -> DataFrame:
    """JSON Lines, compressed or not (by file extension). Without a schema Spark infers one in an extra pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path)


def json_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Text lines, each decoded as one JSON document."""
    return spark.read.text(path).select(parse(F.col("value"), schema).alias("_doc")).select("_doc.*")


def day_partition(spark: SparkSession, base: str, schema: T.StructType, iso_date: str | None = None) -> DataFrame:
    """JSON records below ``base/dt=YYYY-MM-DD``; a day reads its own directory only."""
    table = spark.read.schema(T.StructType(schema.fields + [T.StructField("dt", T.DateType())])).json(base)
    return table if iso_date is None else table.where(F.col("dt") == F.lit(iso_date).cast("date"))


def collection(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
               schema: T.StructType | None = None, path: str | None = None) -> DataFrame:
    """A table of any installed connector. Filter the result: the connector pushes the predicate down."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def kafka_options(servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None) -> dict[str, str]:
    """Options to read a topic. ``per_trigger`` bounds the rows of a micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def message_stream(spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType | None = None,
                   path: str | None = None) -> DataFrame:
    """A stream with a ``value`` column: a topic, or files that hold one."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def topic_replay(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds, from its first offset, as a batch."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, "earliest")).load()
