"""Continuous queries: scoring, enrichment, de-duplication, response listening and request status.

Each function starts one query and returns it. The caller names the checkpoint folder; it holds the progress and the
state and must be a shared folder. ``interval`` is the micro-batch interval, ``None`` works off what is there and ends.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skyledger.operators.lookups import first_per_key
from skyledger.plans import requests as request_plan
from skyledger.plans.scoring import score
from skyledger.plans.training import Model
from skyledger.schemas import STREAM_MESSAGE
from skyledger.sources import keyed
from skyledger.sources.writers import Sink
from skyledger.streaming import messages

INTERVAL = "10 seconds"  # fixed value: micro-batch interval


_starting = threading.Lock()


def _start(stream: DataFrame, writer, checkpoint: str, interval: str | None, partitions: int | None, mode: str = "append") -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    if partitions is None:
        return writer.start()
    conf = stream.sparkSession.conf
    with _starting:  # a query copies the settings of the session when it starts; one start at a time changes them
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)


def per_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
              interval: str | None = INTERVAL, partitions: int | None = None, mode: str = "append") -> StreamingQuery:
    """Run a frame function on every micro-batch.

    ``partitions`` is the number of state partitions, fixed for the life of the checkpoint (by default the session's
    shuffle partitions). Every stateful step keeps that many state stores.
    """
    return _start(stream, stream.writeStream.foreachBatch(fn), checkpoint, interval, partitions, mode)


def to_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL,
             partitions: int | None = None) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once. ``partitions`` as in ``per_batch``."""
    return _start(stream, stream.writeStream.format("parquet").option("path", path), checkpoint, interval, partitions)


def to_console(stream: DataFrame, checkpoint: str, interval: str | None = INTERVAL) -> StreamingQuery:
    """Print a stream."""
    return _start(stream, stream.writeStream.format("console"), checkpoint, interval, None)


def score_stream(source: DataFrame, model: Model, sinks: Iterable[Sink], checkpoint: str,
                 reject_sink: Sink | None = None, interval: str | None = INTERVAL, handle_invalid: str = "keep",
                 index_source: str = "request", schema: StructType = STREAM_MESSAGE) -> StreamingQuery:
    """Parse, score and fan out: every micro-batch is scored once and written to all sinks from the executors.

    Messages without an id go to ``reject_sink``; they are read from the source once more, where only their id is parsed, rather than
    keeping every message as text and as fields. Sinks keyed by batch id stay right when a batch is replayed.
    """
    targets = list(sinks)

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = messages.parsed(batch, schema)
        accepted = messages.requests(parsed, with_indices=index_source == "message")
        scored = score(accepted, model, handle_invalid, index_source).persist()
        try:
            if not scored.isEmpty():
                for sink in targets:
                    sink(scored, batch_id)
            if reject_sink is not None:
                reject_sink(messages.rejects(parsed), batch_id)
        finally:
            scored.unpersist()

    return per_batch(source, run, checkpoint, interval)


def query_id(batch: DataFrame) -> str:
    """The id of the query that runs a micro-batch. It is kept with the checkpoint: a restart has the same, a fresh start another."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def response_sink(path: str) -> Sink:
    """Append scored rows to the response table; ``keyed.responses`` reads the latest per id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = keyed.merged(None, keyed.response_rows(batch), keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
        keyed.append(rows, path, query_id(batch), batch_id)
    return write


def listen_responses(source: DataFrame, path: str, schema: StructType, checkpoint: str,
                     interval: str | None = INTERVAL) -> StreamingQuery:
    """Response messages into the response table at ``path``."""
    sink = response_sink(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(messages.parsed(batch, schema).where("flight.UUID IS NOT NULL").select("flight.*"), batch_id)

    return per_batch(source, run, checkpoint, interval)


def latest_answers(stream: DataFrame, keys: list[str], order: list[str], time: str | None = None, keep: str | None = None) -> DataFrame:
    """The latest row per key so far, by ``order`` and then by the remaining columns: a streaming aggregate for update mode.

    Its state is the table (``keyed.state_table`` reads it), so neither a read nor a restart looks at what was written before. Copies
    of a key combine on the map side of every micro-batch. By default every key stays in the state, as in a keyed table. With ``time``
    and ``keep`` keys are kept per window of that length and forgotten when the watermark, as long behind, has passed the window.
    """
    rest = [name for name in stream.columns if name not in keys and name not in order]
    row = F.max(F.struct(*order, *rest, *keys)).alias("row")
    if time is None:
        return stream.groupBy(*keys).agg(row).select("row.*")
    return stream.withWatermark(time, keep).groupBy(*keys, F.window(time, keep)).agg(row).select("row.*")


def keep_latest(latest: DataFrame, push: Sink, checkpoint: str, interval: str | None = INTERVAL, partitions: int | None = None) -> StreamingQuery:
    """Run ``latest_answers`` and hand the rows of every key that a micro-batch touched to ``push``, which must write all of them.

    The table is in the state below ``checkpoint``; what is pushed may repeat after a restart, with the same rows.
    """
    return per_batch(latest, push, checkpoint, interval, partitions, mode="update")


def enriched(raw: DataFrame, distances: DataFrame, request_id: Column | None = None, **options) -> DataFrame:
    """Raw form rows of a stream to requests: distance, date parts, time and id.

    Streams are not re-planned while they run. If the distances are too large to broadcast, ``spread=n`` splits the
    requests of a hot route over ``n`` tasks.
    """
    return request_plan.realtime_requests(raw, distances, request_id, **options)


def unique_requests(stream: DataFrame, time: str, delay: str, key: str = "UUID") -> DataFrame:
    """One row per id, in one stateful step. Ids are remembered for ``delay`` of event time, which bounds the state.

    A stream has no stateless aggregate. Where an id may have very many copies, send the stream through ``combine_copies`` first
    and read what that wrote.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def combine_copies(stream: DataFrame, path: str, checkpoint: str, key: str = "UUID", interval: str | None = INTERVAL) -> StreamingQuery:
    """Keep one row per id of every micro-batch and write the batches below ``path`` for a stream to read.

    Inside a micro-batch the copies are combined on the map side, so an id that fills the batch is one row per task before
    anything is shuffled, and the stateful step that reads the result gets it once per batch.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path}/writer={query_id(batch)}/batch={batch_id}")

    return per_batch(stream, run, checkpoint, interval)


def request_response(requests: DataFrame, responses: DataFrame, request_time: str, response_time: str,
                     wait: str, delay: str, how: str = "inner", unique: bool = True) -> DataFrame:
    """Pair each request with every response that carries its id and is given within ``wait`` of it.

    Both sides have an event-time watermark and a time bound, so Spark can forget rows that no longer match.
    ``how="left_outer"`` also gives the requests without a response, once the watermark has passed them. Copies of a request
    and rows of a response that were sent twice are dropped first; ``unique=False`` leaves that out for sides without copies. Different
    answers to one request are all paired, since which of them lies inside the bound is known only there: ``first_answers`` keeps
    the earliest.
    """
    if unique:
        left = unique_requests(requests, request_time, delay)
        right = responses.withWatermark(response_time, delay).dropDuplicatesWithinWatermark(responses.columns)
    else:
        left, right = requests.withWatermark(request_time, delay), responses.withWatermark(response_time, delay)
    left, right = left.withColumnRenamed("UUID", "request_uuid"), right.withColumnRenamed("UUID", "response_uuid")
    same = F.col("request_uuid") == F.col("response_uuid")
    in_time = (F.col(response_time) >= F.col(request_time)) & (
        F.col(response_time) <= F.col(request_time) + F.expr(f"INTERVAL {wait}"))
    return left.join(right, same & in_time, how)


def first_answers(pairs: DataFrame, response_time: str) -> DataFrame:
    """Of the pairs that were written, the one with the earliest response per request; a request without one keeps its row.

    The same whatever order micro-batches came in. Equal times are settled by the remaining columns.
    """
    never = F.lit("9999-12-31").cast("timestamp")
    first = first_per_key(pairs.withColumn("_at", F.coalesce(response_time, never)), ["request_uuid"], ["_at"])
    return first.drop("_at")
