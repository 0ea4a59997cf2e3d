"""Summaries. Every aggregate combines on the map side first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the delay classes.
DELAY_SPLITS = [-float("inf"), -15.0, 0.0, 30.0, float("inf")]


def mean_distance(flights: DataFrame) -> DataFrame:
    """Mean distance of every route."""
    return flights.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns that hold nulls and how many, counted in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column_name", "null_count").where("null_count > 0")


def distribution(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def confusion(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per label and prediction; accuracy and both distributions follow from it without another pass."""
    return predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def accuracy(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def flights_by_month(flights: DataFrame) -> DataFrame:
    return flights.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("total_flights"))


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    return airplanes.groupBy("Manufacturer").agg(F.count(F.lit(1)).alias("Total"))


def maximum(df: DataFrame, measure: str, name: str = "max_value") -> DataFrame:
    """Greatest value of a measure, for chart scaling."""
    return df.agg(F.max(measure).alias(name))


def bucket_delay(delay: Column) -> Column:
    """The four delay classes as an expression; lower bounds are included. Nulls and NaN have no class."""
    chosen = F.when(delay.isNull() | F.isnan(delay.cast("double")), F.lit(None).cast("double"))
    for label, upper in enumerate(DELAY_SPLITS[1:-1]):
        chosen = chosen.when(delay < upper, float(label))
    return chosen.otherwise(float(len(DELAY_SPLITS) - 2))


def histogram(df: DataFrame, measure: str, buckets: int) -> DataFrame:
    """Equal-width histogram between the least and greatest value, as ``(label, value)``.

    ``label`` is the bucket number. Buckets without rows are left out; nulls are not counted. NaN and infinite values have no
    place between two bounds: they are counted apart under the label -1.
    """
    known = df.select(F.col(measure).cast("double").alias("_value")).where("_value IS NOT NULL")
    finite = ~F.isnan("_value") & (F.abs("_value") != float("inf"))
    bounds = known.where(finite).agg(F.struct(F.min("_value").alias("low"), F.max("_value").alias("high"))).scalar()
    width = F.nullif(F.col("_bounds")["high"] - F.col("_bounds")["low"], F.lit(0.0))
    position = F.floor((F.col("_value") - F.col("_bounds")["low"]) * buckets / width)
    inside = F.least(F.coalesce(position, F.lit(0)), F.lit(buckets - 1)).cast("int")
    label = F.when(finite, inside).otherwise(-1)
    return known.withColumn("_bounds", bounds).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("value"))


def rank_error(k: int) -> float:
    """Share of the rows by which an edge of ``equal_depth_edges`` may miss its rank, with 99 % confidence, by the size of the sketch."""
    return 2.446 / k ** 0.9433


def equal_depth_edges(df: DataFrame, measure: str, buckets: int, k: int = 800) -> Column:
    """The inner edges that part the known, finite values into ``buckets`` parts of equal size, as an array: a scalar subquery.

    One pass and no sort: a KLL sketch of a few thousand values per task, merged. ``rank_error(k)`` bounds the error of ranks
    whatever the values are. Null where no value is known.
    """
    value = F.col(measure).cast("double")
    known = df.select(value.alias("_value")).where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    sketch = known.agg(F.kll_sketch_agg_double("_value", F.lit(k)).alias("_sketch"))
    ranks = F.array(*[F.lit(float(i) / buckets) for i in range(1, buckets)])
    filled = F.kll_sketch_get_n_double("_sketch") > 0
    return sketch.select(F.when(filled, F.kll_sketch_get_quantile_double("_sketch", ranks))).scalar()


def histogram_equal_depth(df: DataFrame, measure: str, buckets: int, k: int = 800) -> DataFrame:
    """Histogram with buckets of about equal size, as ``(label, low, high, value)``: bucket number, its least and greatest value, its rows.

    Rows are counted exactly, edges come from a sketch. Equal values lie in one bucket, so a value that many rows have makes a
    large bucket and may leave the ones before it out. Nulls, NaN and infinite values are not counted.
    """
    value = F.col(measure).cast("double")
    known = df.select(value.alias("_value")).where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    edged = known.withColumn("_edges", equal_depth_edges(df, measure, buckets, k))
    label = F.size(F.filter(F.col("_edges"), lambda edge: edge < F.col("_value")))
    return edged.groupBy(label.alias("label")).agg(F.min("_value").alias("low"), F.max("_value").alias("high"), F.count(F.lit(1)).alias("value"))


def histogram_by_edges(df: DataFrame, measure: str, edges: list[float]) -> DataFrame:
    """Histogram with given ascending edges: bucket ``i`` holds ``edges[i] <= x < edges[i+1]``, the last also its end."""
    if len(edges) < 2 or sorted(edges) != list(edges):
        raise ValueError("at least two ascending edges are needed")
    value, top = F.col(measure), len(edges) - 2
    label = reduce(
        lambda rest, i: F.when((value >= edges[i]) & ((value < edges[i + 1]) | ((value <= edges[-1]) & F.lit(i == top))), i)
        .otherwise(rest),
        range(top, -1, -1), F.lit(None).cast("int"),
    )
    return df.select(label.alias("label")).where("label IS NOT NULL").groupBy("label").agg(
        F.count(F.lit(1)).alias("value"))
