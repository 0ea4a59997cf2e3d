"""Quality by compression: a text is good if a dictionary of good texts compresses it better than one of bad texts.

Two Zstandard dictionaries are built, one of chunks of good and one of chunks of bad labelled texts. A text is compressed with
each; the size difference, normalised by the root of the text's length, is mapped to the probability of the good label by a
logistic curve. The curve is fitted out of fold: the labelled texts of one fold are compressed with dictionaries of the other
folds, so every label serves both the dictionaries and the calibration, and no text is judged by its own chunks. Nothing but the
text enters a score. All steps are the same whatever the number of labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import stored

LEVEL = 9


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the calibration: the log odds of the good label are ``intercept + slope * difference``."""
    good: bytes
    bad: bytes
    intercept: float
    slope: float

    def score(self, difference: float) -> float:
        odds = self.intercept + self.slope * difference
        return 1 / (1 + math.exp(-min(max(odds, -700.0), 700.0)))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int, folds: int) -> DataFrame:
    """``(doc_id, label, fold, text)`` of at most ``per_class`` ids of each label, chosen by a hash of the id; whole texts.

    Of several texts with one id the smallest is taken. An id that has both labels counts for both.
    """
    picked = None
    for label in (0, 1):
        some = labels.where(F.col("quality") == label).select("doc_id", F.col("quality").alias("label")).distinct().orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # The picked ids are at most 2 * per_class rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return rows.select("doc_id", "label", F.pmod(F.hash("doc_id"), F.lit(folds)).alias("fold"), "text")


def chunks(texts: DataFrame, count: int, size: int) -> list[tuple[int, int, int, object, int, bytes]]:
    """``(label, fold, place, doc_id, at, chunk)`` of the ``count`` chunks of least hash of every label and fold.

    Chunks of ``size`` bytes are cut from whole texts inside tasks. The driver gets at most ``2 * folds * count * size`` bytes.
    """
    cut = texts.select("label", "fold", "doc_id", F.col("text").cast("binary").alias("bytes")).where(F.octet_length("bytes") > 0).select(
        "*", F.explode(F.sequence(F.lit(0), F.expr(f"cast((octet_length(bytes) - 1) div {size} as int)"))).alias("at"))
    cut = cut.select("label", "fold", F.xxhash64("doc_id", "at").alias("place"), "doc_id", "at",
                     F.substring("bytes", F.col("at") * size + 1, F.lit(size)).alias("chunk"))
    nth = F.row_number().over(W.partitionBy("label", "fold").orderBy("place", "doc_id", "at"))
    kept = cut.withColumn("nth", nth).where(F.col("nth") <= count).drop("nth")
    return sorted((r.label, r.fold, r.place, r.doc_id, r.at, bytes(r.chunk)) for r in kept.collect())


def dictionaries(parts: list[tuple[int, int, int, object, int, bytes]], count: int, without: int | None = None) -> tuple[bytes, bytes]:
    """Good and bad dictionary: the chunks of least hash of both labels, without one fold.

    Both have equally many chunks, ``count`` or as many as the smaller class has: a larger dictionary alone would fit better.
    """
    of = {label: sorted((place, doc_id, at, chunk) for y, fold, place, doc_id, at, chunk in parts if y == label and fold != without)
          for label in (0, 1)}
    count = min(count, len(of[0]), len(of[1]))
    made = [b"".join(chunk for *_, chunk in of[label][:count]) or b" " for label in (1, 0)]
    return made[0], made[1]


def compressors(good: bytes, bad: bytes):
    made = []
    for data in (good, bad):
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False))
    return made


def difference(text: bytes, good, bad) -> float:
    """``(bad - good) / sqrt(length)`` of the compressed sizes: above 0 where the good dictionary fits better.

    The difference is a sum over the matches of a text, so its noise grows with the root of the length.
    """
    return (len(bad.compress(text)) - len(good.compress(text))) / math.sqrt(len(text) + 1)


def differences(texts: DataFrame, pairs: list[tuple[bytes, bytes]]) -> list[tuple[float, int]]:
    """Difference and label of every text, by the dictionaries that ``pairs`` has for its fold. Texts stay in the tasks; a number
    per id comes back."""
    def run(batches):
        made = {}
        for batch in batches:
            values = []
            for fold, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if fold not in made:
                    made[fold] = compressors(*pairs[fold])
                values.append(difference(text.as_py().encode(), *made[fold]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["label", "difference"])

    found = texts.select(F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), "text").mapInArrow(
        run, "label int, difference double")
    return sorted((r.difference, r.label) for r in found.collect())


def logistic(points: list[tuple[float, int]], weight: dict[int, float], ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope of the log odds of label 1, by Newton's method on weighted points ``(difference, label)``.

    A small penalty keeps the slope finite where the labels are told apart without an error; it is never below 0.
    """
    x, y = np.array([d for d, _ in points]), np.array([label for _, label in points], dtype=float)
    w = np.array([weight[label] for _, label in points])
    w *= len(w) / w.sum()
    middle, spread = float(np.average(x, weights=w)), float(x.std()) or 1.0
    design, beta = np.column_stack([np.ones(len(x)), (x - middle) / spread]), np.zeros(2)
    value = lambda b: float(w @ (np.logaddexp(0, design @ b) - y * (design @ b))) + ridge / 2 * float(b @ b)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -700, 700)))
        gradient = design.T @ (w * (p - y)) + ridge * beta
        step = np.linalg.solve((design * (w * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
        size = 1.0
        while value(beta - size * step) > value(beta) and size > 1e-9:
            size /= 2
        beta = beta - size * step
        if np.abs(step).max() < 1e-10:
            break
    if beta[1] <= 0:
        share = float(np.average(y, weights=w))
        return math.log(share / (1 - share)), 0.0
    slope = float(beta[1]) / spread
    return float(beta[0]) - slope * middle, slope


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, dictionary_bytes: int = 262_144, chunk_bytes: int = 256,
        folds: int = 5) -> Model:
    """Fit on a bounded sample of labelled rows: ``per_class`` ids of each label (see ``labelled``).

    ``labels`` is ``(doc_id, quality)``; rows with a null in either, or with another quality than 0 or 1, are left out. Both classes
    weigh as they stand in the labels, not as in the sample. Where a class has no text, or all its texts are in one fold, there is
    nothing to calibrate on and the score is the share of the good labels.
    """
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    labels = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    texts = stored(labelled(docs, labels, per_class, folds), "labelled-texts")
    count = dictionary_bytes // chunk_bytes
    parts = chunks(texts, count, chunk_bytes)
    good, bad = dictionaries(parts, count)
    totals = {r.quality: r["count"] for r in labels.groupBy("quality").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len({(y, fold) for y, fold, *_ in parts if y == 0}) < 2 or len({(y, fold) for y, fold, *_ in parts if y == 1}) < 2:
        odds = math.inf if share == 1 else -math.inf if share == 0 else math.log(share / (1 - share))
        return Model(good, bad, odds if totals else 0.0, 0.0)
    points = differences(texts, [dictionaries(parts, count, without=fold) for fold in range(folds)])
    found = {label: sum(y == label for _, y in points) for label in (0, 1)}
    return Model(good, bad, *logistic(points, {label: totals[label] / found[label] for label in (0, 1)}))


def scored(docs: DataFrame, model: Model, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a score between 0 and 1 for every whole text; null texts count as empty.

    A column of the name ``score_col`` is replaced. Rows are scored one by one, so repeated rows repeat their score.
    """
    docs = docs.drop(score_col)
    schema = docs.select("*", F.lit(0.0).alias(score_col)).schema

    def run(batches):
        pair = compressors(model.good, model.bad)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = [model.score(difference((text.as_py() or "").encode(), *pair)) for text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)
