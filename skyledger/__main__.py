"""Command line of the batch and stream jobs, for ``spark-submit``: ``python -m skyledger <job> ..``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skyledger import schemas, session
from skyledger.operators import aggregates
from skyledger.operators.ordering import hash_sample
from skyledger.plans import daily, features, pages, requests, scoring, training
from skyledger.sources import readers, writers
from skyledger.streaming import jobs


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def extract_features(spark: SparkSession, args) -> None:
    flights = spark.read.parquet(args.flights)
    if args.one_in > 1:
        key = F.concat_ws("-", *[F.col(name).cast("string") for name in args.sample_key])
        flights = hash_sample(flights, key, args.one_in)
    features.write(features.extract(flights), args.out, args.compression)


def distances(spark: SparkSession, args) -> None:
    """Mean distances to files, and merged into a new version of the keyed table."""
    made = features.distances(spark.read.parquet(args.flights))
    features.write_distances(made, args.out)
    features.import_distances(spark, args.out, args.table, args.old_table)


def build_pages(spark: SparkSession, args) -> None:
    pages.write(pages.collections(spark.read.parquet(args.flights), spark.read.parquet(args.airplanes)), args.out)


def train(spark: SparkSession, args) -> None:
    rows = features.read(spark, args.features, args.offset_dates)
    aggregates.null_profile(rows).show()
    trained = training.train(rows, args.max_bins)
    training.save(trained.model, args.model)
    print(f"accuracy {trained.accuracy()}")
    trained.distribution().show()
    scored = scoring.score(rows.orderBy("CRSDepTime").limit(6), trained.model, "keep")
    scored.orderBy("CRSDepTime").select("Carrier", "Route", "CRSDepTime", "DepDelay", "ArrDelay", "Prediction").show(truncate=False)


def train_regression(spark: SparkSession, args) -> None:
    model = training.train_regression(features.read(spark, args.features, args.offset_dates))
    training.save_regression(model, args.model)


def _forms(spark: SparkSession, args):
    """Form rows and the distances as they were computed, the same that training saw."""
    return spark.read.schema(schemas.FORM).json(args.forms), features.read_distances(spark, args.distances)


def build_requests(spark: SparkSession, args) -> None:
    """Form rows to requests: appended to a task table, or sent with an id as messages."""
    raw, table = _forms(spark, args)
    if args.topic:
        made = requests.realtime_requests(raw, table, numbering=args.numbering)
        writers.write_topic(made, args.servers, args.topic, args.format)
    else:
        made = requests.batch_requests(raw, table, numbering=args.numbering)
        typed = made.withColumns({"FlightDate": F.col("FlightDate").try_cast("date"),
                                  "Timestamp": F.col("Timestamp").cast("timestamp")})
        writers.append(typed, "parquet", path=args.out)


def regress_requests(spark: SparkSession, args) -> None:
    """Form rows to predicted delays."""
    raw, table = _forms(spark, args)
    asked = requests.regression_requests(raw, table, numbering=args.numbering)
    writers.write_json(training.score_regression(asked, training.load_regression(spark, args.model)), args.out)


def fetch_requests(spark: SparkSession, args) -> None:
    tasks = readers.collection(spark, args.format, _pairs(args.option), path=args.tasks)
    daily.fetch_requests(tasks, f"{args.base}/prediction_tasks_daily", args.date, args.lexical)


def score_day(spark: SparkSession, args) -> None:
    daily.score_day(spark, f"{args.base}/prediction_tasks_daily", f"{args.base}/prediction_results_daily", args.date,
                    training.load(spark, args.model), args.handle_invalid)


def load_results(spark: SparkSession, args) -> None:
    daily.load_results(spark, f"{args.base}/prediction_results_daily", args.table, args.date)


def score_stream(spark: SparkSession, args) -> None:
    schema = None if args.format == "kafka" else schemas.layout(value="string")
    source = readers.message_stream(spark, args.format, _pairs(args.option), schema, args.input)
    sinks = [jobs.response_sink(args.table)]
    sinks.append(writers.topic_sink(args.servers, args.topic) if args.topic else writers.message_log(f"{args.table}-messages"))
    jobs.score_stream(source, training.load(spark, args.model), sinks, args.checkpoint,
                      writers.row_log(f"{args.table}-rejects"), args.interval, args.handle_invalid).awaitTermination()


def listen_responses(spark: SparkSession, args) -> None:
    schema = None if args.format == "kafka" else schemas.layout(value="string")
    source = readers.message_stream(spark, args.format, _pairs(args.option), schema, args.input)
    jobs.listen_responses(source, args.table, schemas.STREAM_RESPONSE, args.checkpoint, args.interval).awaitTermination()


def enrich_stream(spark: SparkSession, args) -> None:
    """A stream of form rows to requests with an id, as messages."""
    stream = readers.message_stream(spark, args.format, _pairs(args.option), schemas.layout(value="string"), args.input)
    raw = stream.select(F.from_json(F.col("value").cast("string"), schemas.FORM).alias("form")).select("form.*")
    made = jobs.enriched(raw, features.read_distances(spark, args.distances), numbering=args.numbering)
    jobs.to_files(writers.as_messages(made), args.out, args.checkpoint, args.interval).awaitTermination()


def status_stream(spark: SparkSession, args) -> None:
    """Requests with the response that came in time, from two streams of messages."""
    sides = []
    for path, name in ((args.requests, "asked_at"), (args.responses, "answered_at")):
        stream = readers.message_stream(spark, args.format, {}, schemas.layout(value="string"), path)
        fields = F.from_json(F.col("value").cast("string"), "UUID string, Timestamp timestamp, Prediction double").alias("m")
        sides.append(stream.select(fields).select("m.UUID", F.col("m.Timestamp").alias(name), F.col("m.Prediction").alias(f"{name}_prediction")))
    paired = jobs.request_response(*sides, "asked_at", "answered_at", args.wait, args.delay, "left_outer")
    made = paired.select(F.col("request_uuid").alias("UUID"), F.when(F.col("response_uuid").isNull(), "WAIT").otherwise("OK").alias("status"),
                         F.col("answered_at_prediction").alias("Prediction"), F.col("answered_at").alias("AnsweredAt"))
    jobs.to_files(made, args.out, args.checkpoint, args.interval).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyledger", description=__doc__)
    subs = top.add_subparsers(dest="job", required=True)

    def job(fn, *names: str) -> argparse.ArgumentParser:
        sub = subs.add_parser(fn.__name__.replace("_", "-"))
        sub.set_defaults(run=fn)
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        return sub

    sub = job(extract_features, "flights", "out")
    sub.add_argument("--compression", default="bzip2")
    sub.add_argument("--one-in", type=int, default=1, help="keep about one in this many flights")
    sub.add_argument("--sample-key", nargs="+", default=["Carrier", "FlightDate", "FlightNum", "Origin", "Dest"])
    sub = job(distances, "flights", "out", "table")
    sub.add_argument("--old-table", help="version of the keyed table to merge with")
    job(build_pages, "flights", "airplanes", "out")
    sub = job(train, "features", "model")
    sub.add_argument("--max-bins", type=int)
    sub.add_argument("--offset-dates", action="store_true")
    sub = job(train_regression, "features", "model")
    sub.add_argument("--offset-dates", action="store_true")
    sub = job(build_requests, "forms", "distances")
    sub.add_argument("--out", help="task table to append to")
    sub.add_argument("--topic", help="request topic, in place of the task table")
    sub.add_argument("--servers", default="")
    sub.add_argument("--format", default="kafka", help="connector of the topic")
    sub.add_argument("--numbering", default="iso", choices=["iso", "weekday0"])
    sub = job(regress_requests, "forms", "distances", "model", "out")
    sub.add_argument("--numbering", default="iso", choices=["iso", "weekday0"])
    sub = job(fetch_requests, "tasks", "base", "date")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--option", nargs="*", default=[], help="connector options as name=value")
    sub.add_argument("--lexical", action="store_true")
    sub = job(score_day, "base", "date", "model")
    sub.add_argument("--handle-invalid", default="error", choices=["error", "skip", "keep"])
    job(load_results, "base", "date", "table")
    sub = job(score_stream, "model", "table", "checkpoint")
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--input", help="path of a file stream")
    sub.add_argument("--option", nargs="*", default=[])
    sub.add_argument("--servers", help="brokers of the response topic")
    sub.add_argument("--topic", help="response topic; without it responses are kept as files")
    sub.add_argument("--interval", help="micro-batch interval; without it the job works off what is there and ends")
    sub.add_argument("--handle-invalid", default="keep", choices=["error", "skip", "keep"])
    sub = job(listen_responses, "table", "checkpoint")
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--input", help="path of a file stream")
    sub.add_argument("--option", nargs="*", default=[])
    sub.add_argument("--interval")
    sub = job(enrich_stream, "input", "distances", "out", "checkpoint")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--option", nargs="*", default=[])
    sub.add_argument("--numbering", default="iso", choices=["iso", "weekday0"])
    sub.add_argument("--interval")
    sub = job(status_stream, "requests", "responses", "out", "checkpoint")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--wait", default="10 MINUTES", help="how long a request waits for its response")
    sub.add_argument("--delay", default="1 hour", help="how late rows may come")
    sub.add_argument("--interval")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(session.prepare(spark or session.builder(f"skyledger {args.job}").getOrCreate()), args)


if __name__ == "__main__":
    main()
