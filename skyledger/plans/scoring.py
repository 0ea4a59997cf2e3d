"""Scoring of request tables with a persisted chain; the same code serves batches and micro-batches."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from skyledger.plans.training import NOMINAL, VECTOR, Model, index_name, indexed, with_route

# Columns the chain adds and no caller needs.
WORKING_COLUMNS = [VECTOR, "rawPrediction", "probability", "indices", "values", *map(index_name, NOMINAL)]


def without_working_columns(scored: DataFrame) -> DataFrame:
    """Drop vectors, indices and raw scores; names that do not occur are ignored."""
    return scored.drop(*WORKING_COLUMNS)


def score(requests: DataFrame, model: Model, handle_invalid: str = "error", index_source: str = "request") -> DataFrame:
    """Add ``Route`` and ``Prediction`` to every request.

    ``handle_invalid`` says what happens to unseen labels and missing numbers: ``error`` fails the job, ``skip`` drops
    the row, ``keep`` scores it with one extra label and NaN. ``index_source="message"`` takes the indices from the
    request itself (missing ones count as NaN) instead of the saved labels.
    """
    if index_source not in ("request", "message"):
        raise ValueError(f"unknown index source: {index_source}")
    sent = index_source == "message"
    rows = with_route(requests.drop("Prediction", *([] if sent else map(index_name, NOMINAL))))
    if not sent:
        rows = indexed(rows, model.labels, model.sizes, model.hashed, handle_invalid, encoded=model.encoded)
    for stage in model.chain.copy().stages:
        if isinstance(stage, VectorAssembler):
            stage.setHandleInvalid("keep" if sent else handle_invalid)
        rows = stage.transform(rows)
    return without_working_columns(rows)
