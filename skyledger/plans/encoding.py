"""Target encoding: a wide nominal column becomes one number, the smoothed mean of the target for its label.

A training row is encoded from the other folds only, so its own target never stands in its features. Rows to score are encoded from
all folds. A rare label is drawn towards the mean of everything, by as many rows as ``weight`` says; an unseen or missing label is
that mean. Sums per label and fold combine on the map side; every join is by label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import work_folder

FOLDS, WEIGHT = 5, 20.0


def sums(rows: DataFrame, columns: list[str], target: str, fold: Column) -> DataFrame:
    """``(column_name, label, fold, n, total)`` of the target, for several columns in one pass. A missing label is a label."""
    known = rows.select(*[F.col(name).cast("string").alias(name) for name in columns], F.col(target).cast("double").alias("_target"), fold.alias("fold"))
    pairs = known.where("_target IS NOT NULL").unpivot(["fold", "_target"], columns, "column_name", "label")
    return pairs.groupBy("column_name", "label", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("_target").alias("total"))


def _smoothed(total: Column, n: Column, prior: Column, weight: float) -> Column:
    return (total + prior * weight) / (n + weight)


def prior_of(parts: DataFrame) -> float:
    """The mean target of all rows: one number."""
    name = parts.select("column_name").first()
    if name is None:
        return 0.0
    row = parts.where(F.col("column_name") == name[0]).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    return row.total / row.n


def means(parts: DataFrame, prior: float, weight: float = WEIGHT) -> DataFrame:
    """``(column_name, label, mean)`` from all folds, for rows to score."""
    whole = parts.groupBy("column_name", "label").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return whole.select("column_name", "label", _smoothed(F.col("total"), F.col("n"), F.lit(prior), weight).alias("mean"))


def fold_means(parts: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """``(column_name, label, fold, mean)`` for training rows: what the other folds say, smoothed by the other folds' mean."""
    per_label = parts.groupBy("column_name", "label").agg(F.sum("n").alias("all_n"), F.sum("total").alias("all_total"))
    per_fold = parts.groupBy("column_name", "fold").agg(F.sum("n").alias("fold_n"), F.sum("total").alias("fold_total"))
    per_column = parts.groupBy("column_name").agg(F.sum("n").alias("whole_n"), F.sum("total").alias("whole_total"))
    # Few rows: a column and fold each.
    others = per_fold.join(per_column, "column_name").select(
        "column_name", "fold", ((F.col("whole_total") - F.col("fold_total")) / F.nullif(F.col("whole_n") - F.col("fold_n"), F.lit(0))).alias("prior"))
    joined = parts.join(per_label.withColumnsRenamed({"column_name": "_column", "label": "_label"}),
                        (F.col("column_name") == F.col("_column")) & F.col("label").eqNullSafe(F.col("_label"))).join(others, ["column_name", "fold"])
    mean = _smoothed(F.col("all_total") - F.col("total"), F.col("all_n") - F.col("n"), F.coalesce("prior", F.lit(0.0)), weight)
    return joined.select("column_name", "label", "fold", mean.alias("mean"))


def encoded_by_fold(rows: DataFrame, columns: list[str], target: str, fold: Column, names: dict[str, str], weight: float = WEIGHT,
                    parts: DataFrame | None = None) -> DataFrame:
    """Training rows with ``names[column]``, encoded out of fold. Rows without a target are encoded like the others of their fold.

    Sums and means are written once: the rows are summed in one pass, and the planner knows how large the means are. Where they are
    small, as with few labels, they are sent to the rows, and no row is moved.
    """
    spark = rows.sparkSession
    kept = lambda made, name: (made.write.parquet(path := work_folder(spark, name)), spark.read.parquet(path))[1]
    table = kept(fold_means(kept(sums(rows, columns, target, fold), "target-sums") if parts is None else parts, weight), "fold-means")
    out = rows.withColumn("_fold", fold)
    for name in columns:
        known = table.where(F.col("column_name") == name).select(F.col("label").alias("_label"), F.col("fold").alias("_of"), F.col("mean").alias(names[name]))
        out = out.join(known, (F.col("_fold") == F.col("_of")) & F.col(name).cast("string").eqNullSafe(F.col("_label")), "left").drop("_label", "_of")
    return out.drop("_fold")
