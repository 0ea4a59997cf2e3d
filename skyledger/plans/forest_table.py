"""A trained forest as a table of nodes, and scoring by joins with it.

The files of a saved forest are a table already; ``nodes`` gives it plain columns. Any engine that can join can score with it: a row
starts at the root of every tree and moves to a child by one equi-join per level. The classes equal those of the trained chain.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.aggregates import DELAY_SPLITS
from skyledger.plans.training import PREDICTION, VECTOR, Model, assembler, indexed, with_route


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """``(tree, node, leaf, feature, threshold, left_values, unseen_left, left, right, votes)`` of the model saved at ``path``.

    A numeric feature goes left up to ``threshold``, a nominal one when its index is in ``left_values``. An index that training has
    not seen goes the way of the larger part of the values, which ``unseen_left`` names by the first such index, null if that is
    right. ``votes`` are the shares of the classes at the node.
    """
    data = spark.read.parquet(f"{path}/pipeline/stages/*RandomForest*/data").select("treeID", "nodeData.*")
    nominal = F.col("split.numCategories") >= 0  # a leaf has neither values nor a threshold
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), (F.col("leftChild") < 0).alias("leaf"),
        F.col("split.featureIndex").alias("feature"), F.when(~nominal, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(nominal, F.col("split.leftCategoriesOrThreshold")).alias("left_values"),
        F.when(nominal & (F.size("split.leftCategoriesOrThreshold") > F.floor(F.col("split.numCategories") / 2)),
               F.col("split.numCategories")).alias("unseen_left"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), F.transform("impurityStats", lambda x: x / F.nullif(total, F.lit(0.0))).alias("votes"))


def levels(table: DataFrame) -> int:
    """Joins that lead from the roots to the last leaves; the table has some thousand rows."""
    edges = table.where("NOT leaf").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    reached, depth = table.groupBy("tree").agg(F.min("node").alias("node")), 0
    while True:
        reached = reached.join(edges, ["tree", "node"]).select("tree", F.col("child").alias("node"))
        if reached.isEmpty():
            return depth
        depth += 1


def classified(features: DataFrame, table: DataFrame, key: str, depth: int) -> DataFrame:
    """``(key, Prediction)`` of rows ``(key, features)``, an array of numbers in the order of the chain.

    The class is the one with the greatest sum of votes, the smaller of equal ones. Votes of a row are added in the order of trees.
    """
    value = F.get("features", "feature")
    nominal = _in_left_bits(value) | F.coalesce(value >= F.col("unseen_left"), F.lit(False))
    goes_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(nominal)
    trees = table.groupBy("tree").agg(F.min("node").alias("node"))
    # The nodes are those of a model that every task can hold: they meet the rows where these are, whatever the planner guesses of their size.
    steps = F.broadcast(table.select("tree", "node", "leaf", "feature", "threshold", _left_bits().alias("left_bits"), "unseen_left", "left", "right"))
    # Rows are spread over all cores before they stand once per tree: a table read as one file would walk every tree in one task.
    spark = features.sparkSession
    features = features.repartition(max(spark.sparkContext.defaultParallelism, features.rdd.getNumPartitions()), key)
    # A row stands once per tree, of which there are a few.
    at = features.select(key, "features", F.explode(trees.agg(F.collect_list(F.struct("tree", "node"))).scalar()).alias("at")).select(key, "features", "at.*")
    for _ in range(depth):
        step = at.join(steps, ["tree", "node"])
        child = F.when(F.col("leaf"), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = step.select(key, "features", "tree", F.coalesce(child, F.lit(-1)).alias("node"))  # never null, so the next join need not ask
    voted = at.join(F.broadcast(table.select("tree", "node", "votes")), ["tree", "node"])
    ballots = voted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("tree", "votes"))).alias("ballots"))
    sums = F.array(*[_sum_of(place) for place in range(len(DELAY_SPLITS) - 1)])
    return ballots.select(key, (F.array_position(sums, F.array_max(sums)) - 1).cast("double").alias(PREDICTION))


def _left_bits() -> Column:
    """``left_values``, indices from 0, as bits of whole numbers: a row asks for one bit and does not run through the values."""
    place = lambda value: value.cast("int")
    word = lambda number: F.aggregate(
        F.filter("left_values", lambda value: F.shiftright(place(value), 6) == number), F.lit(0).cast("bigint"),
        lambda bits, value: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place(value).bitwiseAND(F.lit(63)))))
    words = F.sequence(F.lit(0), F.shiftright(place(F.array_max("left_values")), 6))
    return F.when(F.size("left_values") > 0, F.transform(words, word))


def _in_left_bits(value: Column) -> Column:
    """Whether the value is one of ``left_values``; null only where ``value`` or they are missing."""
    place = value.try_cast("int")
    word = F.get("left_bits", F.shiftright(place, 6))
    bit = F.call_function("shiftright", word, place.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return (place >= 0) & (place == value) & F.coalesce(bit, F.lit(False))


def feature_rows(requests: DataFrame, model: Model, key: str) -> DataFrame:
    """``(key, features)`` of requests, numbers and indices in the order of the chain; unseen labels get one index more."""
    rows = indexed(with_route(requests), model.labels, model.sizes, model.hashed, "keep", encoded=model.encoded)
    return assembler("keep").transform(rows).select(key, vector_to_array(VECTOR).alias("features"))


def _sum_of(place: int) -> Column:
    return F.aggregate("ballots", F.lit(0.0), lambda total, ballot: total + F.get(ballot["votes"], F.lit(place)))
