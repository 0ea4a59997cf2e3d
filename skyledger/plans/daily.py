"""The daily chain: fetch a day's requests, score them, load the results, list them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions import times
from skyledger.functions.text import DELAY_CLASSES, class_label
from skyledger.plans.scoring import score
from skyledger.plans.training import Model
from skyledger.schemas import BATCH_REQUEST, layout
from skyledger.sources.readers import day_partition
from skyledger.sources.writers import replace_day, replace_days


def of_day(column: str, iso_date: str, lexical: bool = False) -> Column:
    """Rows of one day. ``lexical`` compares ISO text and lets a bare next-day date in."""
    field = F.col(column)
    return times.within_day_text(field, iso_date) if lexical else times.within_day(field, iso_date)


def fetch_requests(tasks: DataFrame, base: str, iso_date: str, lexical: bool = False) -> None:
    """Copy a day's requests to its directory, replacing what is there."""
    replace_day(tasks.where(of_day("Timestamp", iso_date, lexical)), base, iso_date)


def fetch_all_requests(tasks: DataFrame, base: str) -> None:
    """``fetch_requests`` for every day of the table in one job."""
    replace_days(tasks.withColumn("dt", F.col("Timestamp").cast("date")), base)


def result_schema(request_schema: StructType = BATCH_REQUEST) -> StructType:
    """Layout of a day's results: the request fields, the route and the class."""
    return StructType(request_schema.fields + layout(Route="string", Prediction="double").fields)


def score_day(spark: SparkSession, tasks_base: str, results_base: str, iso_date: str, model: Model,
              handle_invalid: str = "error", schema=BATCH_REQUEST) -> None:
    """Score a day's requests and replace the day's results."""
    requests = day_partition(spark, tasks_base, schema, iso_date).drop("dt")
    replace_day(score(requests, model, handle_invalid), results_base, iso_date)


def score_all_days(spark: SparkSession, tasks_base: str, results_base: str, model: Model,
                   handle_invalid: str = "error", schema=BATCH_REQUEST) -> None:
    """``score_day`` for every stored day in one job."""
    replace_days(score(day_partition(spark, tasks_base, schema), model, handle_invalid), results_base)


def load_results(spark: SparkSession, results_base: str, table_path: str, iso_date: str, schema=None) -> None:
    """Copy a day's results into the result table.

    The day is replaced whatever it holds: a rerun does not duplicate it, and a day that became empty leaves no old rows.
    """
    day = day_partition(spark, results_base, schema or result_schema(), iso_date).drop("dt")
    day.write.mode("overwrite").parquet(f"{table_path}/dt={iso_date}")


def results_page(results: DataFrame, iso_date: str, labels: dict[int, str] = DELAY_CLASSES,
                 lexical: bool = False) -> DataFrame:
    """A day's results with the predicted class as text."""
    return results_table(results.where(of_day("Timestamp", iso_date, lexical)), labels)


def results_table(results: DataFrame, labels: dict[int, str] = DELAY_CLASSES) -> DataFrame:
    """The eight columns of the results table (fixed values)."""
    return results.select("Timestamp", "Carrier", "FlightDate", "Origin", "Dest", "Distance", "DepDelay",
                          class_label(F.col("Prediction"), labels).alias("Predicted"))
