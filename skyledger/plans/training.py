"""Training, evaluation and persistence of the delay models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.functions.forms import hash_bucket
from skyledger.functions.text import route
from skyledger.operators.aggregates import DELAY_SPLITS, confusion
from skyledger.plans import encoding
from skyledger.session import work_folder

# Model inputs.
NUMERIC = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
NOMINAL = ["Carrier", "Origin", "Dest", "Route"]
LABEL, VECTOR, PREDICTION = "ArrDelayBucket", "Features_vec", "Prediction"
BROADCAST_LABELS = 100_000  # label tables of at most this many rows per column are sent to the rows, not the rows to them


def index_name(column: str) -> str:
    return f"{column}_index"


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("Route", route(F.col("Origin"), F.col("Dest")))


def delay_bucketizer() -> Bucketizer:
    return Bucketizer(splits=DELAY_SPLITS, inputCol="ArrDelay", outputCol=LABEL)


def label_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, label, rows)`` for several text columns in one pass, combined on the map side."""
    pairs = df.select(*[F.col(name).cast("string").alias(name) for name in columns]).unpivot(
        [], columns, "column_name", "label")
    return pairs.where("label IS NOT NULL").groupBy("column_name", "label").agg(F.count(F.lit(1)).alias("rows"))


def label_index(df: DataFrame, columns: list[str] = NOMINAL) -> DataFrame:
    """``(column_name, label, rows, index)``: labels numbered from 0, most frequent first, ties by label.

    The index is a table of any size. Labels are dealt into ranges in that order and numbered inside their partition; a range
    starts where the ones before it end. Only the ranges' sizes meet in one place, not the labels.
    """
    order = [F.col("column_name"), F.col("rows").desc(), F.col("label")]
    ranged = label_counts(df, columns).repartitionByRange(*order).sortWithinPartitions(*order)
    path = work_folder(df.sparkSession, "label-places")  # the places below are read twice and must not be dealt anew
    ranged.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = placed.groupBy("column_name", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(W.partitionBy("column_name").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("column_name", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(starts, ["column_name", "_part"]).select(
        "column_name", "label", "rows", (F.col("_before") + F.col("_id") - F.col("_first")).cast("double").alias("index"))


@dataclass
class Model:
    """The label table, the number of labels per nominal column, and the chain behind them: assembler and forest.

    ``hashed`` names columns that are indexed by a hash of that many values in place of the label table. ``encoded`` names columns
    that stand for a number, the mean delay of their label, with the number of an unseen label; the label table holds it as index.
    """
    labels: DataFrame
    sizes: dict[str, int]
    chain: PipelineModel
    hashed: dict[str, int]
    encoded: dict[str, float] = field(default_factory=dict)


def indexed(rows: DataFrame, labels: DataFrame, sizes: dict[str, int], hashed: dict[str, int], handle_invalid: str,
            columns: list[str] = NOMINAL, encoded: dict[str, float] | None = None) -> DataFrame:
    """Add the index of every nominal column by a join with the label table.

    Unseen and missing labels fail the job (``error``), lose their row (``skip``) or get one index more (``keep``). The columns
    say how many values they have, so the forest treats them as categories. A column in ``encoded`` becomes a plain number.
    """
    encoded = encoded or {}
    for name in columns:
        if name in encoded:
            known = labels.where(F.col("column_name") == name).select(F.col("label").alias("_label"), F.col("index").alias("_index"))
            rows = rows.join(known, F.col(name).cast("string").eqNullSafe(F.col("_label")), "left")
            rows = rows.withColumn(index_name(name), F.coalesce("_index", F.lit(encoded[name]))).drop("_label", "_index")
            continue
        values = hashed.get(name) or sizes.get(name, 0) + (handle_invalid == "keep")
        about = {"ml_attr": {"type": "nominal", "name": index_name(name), "num_vals": max(values, 1)}}
        if name in hashed:
            found = F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(values)).cast("double")
        else:
            known = labels.where(F.col("column_name") == name).select(F.col("label").alias("_label"), F.col("index").alias("_index"))
            if sizes.get(name, 0) <= BROADCAST_LABELS:
                # Few labels meet the rows where they are read; a join dealt by label puts all rows of one label in one task.
                known = F.broadcast(known)
            rows = rows.join(known, F.col(name).cast("string") == F.col("_label"), "left").drop("_label")
            found = F.col("_index")
            if handle_invalid == "keep":
                found = F.coalesce(found, F.lit(float(sizes.get(name, 0))))
            elif handle_invalid == "error":
                found = F.coalesce(found, F.raise_error(F.concat(F.lit(f"no index for {name} "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("double"))
        rows = rows.withColumn("_found", found).drop("_index")
        if handle_invalid == "skip":
            rows = rows.where("_found IS NOT NULL")
        rows = rows.withColumn(index_name(name), F.col("_found").alias(index_name(name), metadata=about)).drop("_found")
    return rows


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=NUMERIC + [index_name(name) for name in NOMINAL], outputCol=VECTOR,
                           handleInvalid=handle_invalid)


@dataclass
class Trained:
    """A fitted chain and the confusion counts of the rows it was evaluated on."""
    model: Model
    confusion: DataFrame

    def accuracy(self) -> float:
        right = F.sum(F.when(F.col(LABEL) == F.col(PREDICTION), F.col("rows")).otherwise(0))
        return self.confusion.agg(right / F.sum("rows")).first()[0]

    def distribution(self) -> DataFrame:
        return self.confusion.groupBy(PREDICTION).agg(F.sum("rows").alias("count"))


def train(features: DataFrame, max_bins: int | None = None, max_memory_mb: int = 1024, seed: int = 1,
          holdout: DataFrame | None = None, hashed: dict[str, int] | None = None, encoded: tuple[str, ...] = ()) -> Trained:
    """Fit the delay classifier on all rows: bucketise, index, assemble, random forest.

    ``max_bins`` defaults to the number of labels of the largest nominal column (at least 32), the least the forest accepts.
    For columns with more labels than a forest should split on the caller chooses ``encoded``, the mean delay of the label, taken
    out of fold for the training rows (``plans.encoding``), or ``hashed``, column to number of hash values. The seed is fixed: left out, it would differ between Python processes. Bootstrap samples also depend on how rows lie
    in partitions, so two runs agree when their input files and settings do. Only the label and the vector are kept while the
    forest iterates. Evaluation runs on the training rows unless ``holdout`` is given.
    """
    hashed = hashed or {}
    routed = with_route(features).select(*NUMERIC, *NOMINAL, "ArrDelay")
    numbered = [name for name in NOMINAL if name not in encoded]
    labels = label_index(routed, [name for name in numbered if name not in hashed]).select("column_name", "label", "index")
    sizes = _sizes(labels)
    rows = indexed(routed, labels, sizes, hashed, "error", numbered)
    priors: dict[str, float] = {}
    if encoded:
        # Equal rows share a fold, so no row is encoded from a copy of itself.
        fold = hash_bucket(F.to_json(F.struct(*NUMERIC, *NOMINAL, "ArrDelay")), encoding.FOLDS)
        path = work_folder(features.sparkSession, "target-sums")
        encoding.sums(routed, list(encoded), "ArrDelay", fold).write.parquet(path)
        parts = features.sparkSession.read.parquet(path)
        priors = dict.fromkeys(encoded, encoding.prior_of(parts))
        rows = encoding.encoded_by_fold(rows, list(encoded), "ArrDelay", fold, {name: index_name(name) for name in encoded}, parts=parts)
        means = encoding.means(parts, next(iter(priors.values())))
        labels = labels.unionByName(means.withColumnRenamed("mean", "index"))
    rows = delay_bucketizer().transform(rows)
    vectors = assembler()
    prepared = vectors.transform(rows).select(VECTOR, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    largest = max([*sizes.values(), *hashed.values(), 32])
    forest = RandomForestClassifier(
        featuresCol=VECTOR, labelCol=LABEL, predictionCol=PREDICTION, maxBins=max_bins or largest,
        maxMemoryInMB=max_memory_mb, seed=seed)
    try:
        fitted = forest.fit(prepared)
        model = Model(labels, sizes, PipelineModel([vectors, fitted]), hashed, priors)
        if holdout is None:
            judged = fitted.transform(prepared)
        else:
            asked = indexed(delay_bucketizer().transform(with_route(holdout)), labels, sizes, hashed, "error", encoded=priors)
            judged = model.chain.transform(asked)
        counts = confusion(judged.select(LABEL, PREDICTION), LABEL, PREDICTION).collect()  # at most 4 x 4 rows
    finally:
        prepared.unpersist()
    table = features.sparkSession.createDataFrame(counts, f"{LABEL} double, {PREDICTION} double, rows long")
    return Trained(model, table)


def _sizes(labels: DataFrame) -> dict[str, int]:
    """Labels per nominal column: at most one row for each."""
    return {row["column_name"]: row["count"] for row in labels.groupBy("column_name").count().collect()}


def evaluate(predictions: DataFrame, metric: str = "accuracy") -> float:
    """MLlib evaluation of scored rows that carry their class."""
    return MulticlassClassificationEvaluator(
        predictionCol=PREDICTION, labelCol=LABEL, metricName=metric).evaluate(predictions)


def save(model: Model, path: str) -> None:
    """Persist chain and label table as one artefact, with the bucketiser of the label beside it."""
    model.chain.write().overwrite().save(f"{path}/pipeline")
    model.labels.write.mode("overwrite").parquet(f"{path}/labels")
    hashed = model.labels.sparkSession.createDataFrame(list(model.hashed.items()), "column_name string, buckets long")
    hashed.write.mode("overwrite").parquet(f"{path}/hashed")
    encoded = model.labels.sparkSession.createDataFrame(list(model.encoded.items()), "column_name string, prior double")
    encoded.write.mode("overwrite").parquet(f"{path}/encoded")
    delay_bucketizer().write().overwrite().save(f"{path}/bucketizer")


def load(spark: SparkSession, path: str) -> Model:
    labels = spark.read.parquet(f"{path}/labels")
    hashed = {row.column_name: row.buckets for row in spark.read.parquet(f"{path}/hashed").collect()}
    encoded = {row.column_name: row.prior for row in spark.read.parquet(f"{path}/encoded").collect()}
    numbered = labels.where(~F.col("column_name").isin(list(encoded))) if encoded else labels
    return Model(labels, _sizes(numbered), PipelineModel.load(f"{path}/pipeline"), hashed, encoded)


def load_bucketizer(spark: SparkSession, path: str) -> Bucketizer:
    return Bucketizer.load(f"{path}/bucketizer")


# --- regression -------------------------------------------------------------------------------------------------------

# Inputs of the regression.
REGRESSION_TEXT = ["Origin", "Dest", "FlightNum"]
REGRESSION_NUMERIC = ["Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]


def regression_inputs(df: DataFrame) -> DataFrame:
    """Features of the delay regression. Departure delay and carrier are not among them."""
    return df.select("*", *[F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(f"_{name}")
                            for name in REGRESSION_NUMERIC])


@dataclass
class Regression:
    """The label table, the labels per text field, and the chain behind them: one-hot vectors, assembler and line."""
    labels: DataFrame
    sizes: dict[str, int]
    chain: PipelineModel


def train_regression(features: DataFrame, text: list[str] = REGRESSION_TEXT, numeric: list[str] = REGRESSION_NUMERIC, max_iter: int = 25,
                     regularisation: float = 0.01, tolerance: float = 1e-6) -> Regression:
    """Linear regression of the arrival delay.

    Every label of a text field has a weight of its own: labels are numbered in a table and become sparse vectors with a single
    entry. The line has as many weights as there are labels, however they are spelt; no two share one. A label that training has not
    seen has none.
    """
    rows = regression_inputs(features).select(*text, *[f"_{name}" for name in numeric], "ArrDelay")
    labels = label_index(rows, text).select("column_name", "label", "index")
    sizes = _sizes(labels)
    entries = [f"{name}_entry" for name in text]
    one_hot = OneHotEncoder(inputCols=[index_name(name) for name in text], outputCols=entries, dropLast=False)
    vectors = VectorAssembler(inputCols=[*entries, *[f"_{name}" for name in numeric]], outputCol=VECTOR)
    line = LinearRegression(featuresCol=VECTOR, labelCol="ArrDelay", predictionCol="Delay", solver="l-bfgs",
                            maxIter=max_iter, regParam=regularisation, tol=tolerance)
    numbered = indexed(rows, labels, sizes, {}, "keep", text)
    encoder = one_hot.fit(numbered)
    prepared = vectors.transform(encoder.transform(numbered)).select(VECTOR, "ArrDelay").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = line.fit(prepared)
    finally:
        prepared.unpersist()
    return Regression(labels, sizes, PipelineModel([encoder, vectors, fitted]))


def score_regression(requests: DataFrame, model: Regression) -> DataFrame:
    """Add the predicted ``Delay`` to every request."""
    text = sorted(model.sizes)
    working = {VECTOR, *[index_name(name) for name in text], *[f"{name}_entry" for name in text], *[f"_{name}" for name in REGRESSION_NUMERIC]}
    scored = model.chain.transform(indexed(regression_inputs(requests), model.labels, model.sizes, {}, "keep", text))
    return scored.drop(*working)


def regression_weights(model: Regression) -> DataFrame:
    """``(column_name, label, weight)`` of every label of the text fields; numeric fields follow with their name and no label.

    The weights of a line are in the driver's memory; the rows are spread from there.
    """
    spark = model.labels.sparkSession
    encoder, vectors, line = model.chain.stages
    offset, starts = 0, []
    for name, size in zip(encoder.getInputCols(), encoder.categorySizes, strict=True):
        starts.append((name.removesuffix("_index"), offset))
        offset += size
    numeric = vectors.getInputCols()[len(starts):]
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(line.coefficients)], "place long, weight double")
    firsts = spark.createDataFrame(starts, "column_name string, first long")
    placed = model.labels.join(firsts, "column_name").select("column_name", "label", (F.col("first") + F.col("index")).cast("long").alias("place"))
    plain = spark.createDataFrame([(name[1:], None, offset + i) for i, name in enumerate(numeric)] + [("intercept", None, -1)],
                                  "column_name string, label string, place long")
    known = placed.unionByName(plain).join(weights.unionByName(spark.createDataFrame([(-1, float(line.intercept))], "place long, weight double")), "place")
    return known.select("column_name", "label", "weight")


def save_regression(model: Regression, path: str) -> None:
    model.chain.write().overwrite().save(f"{path}/pipeline")
    model.labels.write.mode("overwrite").parquet(f"{path}/labels")


def load_regression(spark: SparkSession, path: str) -> Regression:
    labels = spark.read.parquet(f"{path}/labels")
    return Regression(labels, _sizes(labels), PipelineModel.load(f"{path}/pipeline"))


def line_of(x: str, y: str) -> list[Column]:
    """Slope and intercept of the least-squares line through two numeric columns, as aggregates: one pass, beside any others."""
    return [F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
            F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept")]


def fit_line(rows: DataFrame, x: str, y: str) -> DataFrame:
    """The least-squares line of the rows where both columns are known, ``(slope, intercept)``."""
    return rows.agg(*line_of(x, y))
