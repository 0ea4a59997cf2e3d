"""Streams over files, compared with the batch result on the same rows."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions import messages as message_functions
from skyledger.functions import times
from skyledger.plans import scoring, training
from skyledger.sources import keyed, readers, writers
from skyledger.streaming import jobs, messages
from tests.conftest import rows

VALUE = "value binary"
START = dt.datetime(2016, 12, 25)


def wait(query):
    assert query.awaitTermination(120)


def message_files(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame([(bytearray(m, "utf8"),) for m in batch], VALUE).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, spark.createDataFrame([], VALUE).schema, path)


def request(i, **changes):
    import json
    made = {"UUID": f"u{i}", "Timestamp": (START + dt.timedelta(seconds=i)).isoformat(), "FlightDate": "2016-12-25",
            "Origin": ["ATL", "SFO"][i % 2], "Dest": ["ORD", "JFK", "SAN"][i % 3], "Carrier": ["AA", "DL"][i % 2],
            "FlightNum": str(i), "DepDelay": float(i % 90 - 30), "Distance": 606.0, "DayOfYear": 360, "DayOfMonth": 25,
            "DayOfWeek": 7, **changes}
    return json.dumps({k: v for k, v in made.items() if v is not None})


@pytest.fixture(scope="module")
def model(spark):
    pick = random.Random(2)
    made = [(float(d), d + pick.uniform(-3, 3), ["AA", "DL"][i % 2], ["ATL", "SFO"][i % 2], ["ORD", "JFK", "SAN"][i % 3],
             606.0, 25, 7, 360) for i in range(600) for d in [pick.randrange(-40, 90)]]
    df = spark.createDataFrame(made, "DepDelay double, ArrDelay double, Carrier string, Origin string, Dest string, "
                                     "Distance double, DayOfMonth int, DayOfWeek int, DayOfYear int")
    return training.train(df, seed=1).model


def test_scored_stream_equals_batch(spark, model, tmp_path):
    inbox = str(tmp_path / "inbox")
    batches = [[request(i) for i in range(0, 40)], [request(i) for i in range(40, 60)] + ["{bad", '{"Carrier":"AA"}'],
               [request(70, Carrier="??", DepDelay=None), request(1, DepDelay=80.0)]]
    message_files(spark, inbox, *batches)
    table = str(tmp_path / "table")
    log, rejects, check = (str(tmp_path / n) for n in ("log", "rejects", "checkpoint"))

    def run():
        wait(jobs.score_stream(source(spark, inbox), model, [writers.message_log(log), jobs.response_sink(table)], check,
                               reject_sink=writers.row_log(rejects), interval=None))
    run()
    everything = spark.read.parquet(inbox)
    parsed = messages.parsed(everything)
    expected = scoring.score(messages.requests(parsed), model, "keep")
    sent = spark.read.parquet(log)
    assert rows(sent.select("value")) == rows(writers.as_messages(expected))
    assert keyed.responses(spark, table).count() == expected.select("UUID").distinct().count() == 61
    assert keyed.responses(spark, table).where("uuid = 'u1'").first().depdelay == 80.0
    assert rows(spark.read.parquet(rejects).select("value")) == [('{"Carrier":"AA"}',), ("{bad",)]

    run()  # nothing new: nothing changes
    assert spark.read.parquet(log).count() == 62
    message_files(spark, inbox, [request(100)])
    run()  # goes on where it stopped
    assert spark.read.parquet(log).count() == 63 and keyed.responses(spark, table).count() == 62


def test_replayed_batch_does_not_duplicate(spark, model, tmp_path):
    batch = spark.createDataFrame([(bytearray(request(i), "utf8"),) for i in range(10)], VALUE)
    scored = scoring.score(messages.requests(messages.parsed(batch)), model, "keep")
    table = str(tmp_path / "table")
    for sink in (writers.message_log(str(tmp_path / "log")), jobs.response_sink(table)):
        for _ in range(2):
            sink(scored, 0)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 10 == keyed.responses(spark, table).count()


def test_sent_indices_are_used(spark, model, tmp_path):
    inbox = str(tmp_path / "inbox")
    message_files(spark, inbox, [request(i) for i in range(10)])
    out = str(tmp_path / "rows")
    wait(jobs.score_stream(source(spark, inbox), model, [writers.row_log(out)], str(tmp_path / "c"), interval=None,
                           index_source="message"))
    assert spark.read.parquet(out).count() == 10


def test_empty_batch_writes_nothing(spark, model, tmp_path):
    inbox = str(tmp_path / "inbox")
    message_files(spark, inbox, ["{bad"])
    calls = []
    wait(jobs.score_stream(source(spark, inbox), model, [lambda df, i: calls.append(i)], str(tmp_path / "c"), interval=None))
    assert calls == []


def test_duplicates_across_batches(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    message_files(spark, inbox, [request(i % 5) for i in range(200)], [request(i) for i in range(8)])
    stream = messages.requests(messages.parsed(source(spark, inbox)))
    unique = jobs.unique_requests(stream.select("UUID", "Timestamp"), "Timestamp", "1 hour")
    wait(jobs.to_files(unique, out, str(tmp_path / "c"), interval=None))
    assert rows(spark.read.parquet(out).select("UUID")) == [(f"u{i}",) for i in range(8)]


def test_state_partitions_are_set_for_the_query_only(spark, tmp_path):
    inbox, out, check = (str(tmp_path / n) for n in ("inbox", "out", "c"))
    message_files(spark, inbox, [request(i) for i in range(5)])
    stream = messages.requests(messages.parsed(source(spark, inbox)))
    unique = jobs.unique_requests(stream, "Timestamp", "1 hour")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wait(jobs.to_files(unique, out, check, interval=None, partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(glob.glob(f"{check}/state/0/[0-9]*")) == 3
    assert spark.read.parquet(out).count() == 5


def test_enriched_stream_equals_batch(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    schema = schemas.FORM
    made = [("5", "AA", "2016-12-25", "SFO", "1519", "ATL"), ("abc", "AA", "2016-12-26", "XXX", "1", "ATL")]
    spark.createDataFrame(made, schema).write.parquet(inbox)
    distances = spark.createDataFrame([("ATL", "SFO", 2139.5)], "Origin string, Dest string, Distance double")
    key = F.col("FlightNum")
    stream = readers.message_stream(spark, "parquet", {}, schema, inbox)
    wait(jobs.to_files(jobs.enriched(stream, distances, key, as_of="t"), out, str(tmp_path / "c"), interval=None))
    batch = jobs.enriched(spark.read.parquet(inbox), distances, key, as_of="t")
    assert rows(spark.read.parquet(out).select(*batch.columns)) == rows(batch)


def test_listener_keeps_the_latest(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    message_files(spark, inbox, ['{"UUID":"a","Timestamp":"1","Prediction":0.0}', '{"UUID":"a","Timestamp":"2","Prediction":1.0}', "x"],
                  ['{"UUID":"b","Timestamp":"1","Prediction":2.0}'])
    table = str(tmp_path / "table")
    wait(jobs.listen_responses(source(spark, inbox), table, schemas.STREAM_RESPONSE, str(tmp_path / "c"), interval=None))
    assert rows(keyed.responses(spark, table).select("uuid", "prediction")) == [("a", 1.0), ("b", 2.0)]
    assert not glob.glob(f"{table}/writer=batch")  # the writer is the query's own id


def test_fresh_checkpoints_and_two_streams_share_a_table(spark, tmp_path):
    table = str(tmp_path / "table")
    for turn, (uuid, value) in enumerate([("a", 1.0), ("b", 2.0), ("a", 3.0)]):
        inbox = str(tmp_path / f"inbox{turn}")
        message_files(spark, inbox, [f'{{"UUID":"{uuid}","Timestamp":"1","Prediction":{value}}}'])
        wait(jobs.listen_responses(source(spark, inbox), table, schemas.STREAM_RESPONSE, str(tmp_path / f"c{turn}"), interval=None))
    assert rows(keyed.responses(spark, table).select("uuid", "prediction")) == [("a", 3.0), ("b", 2.0)]  # of equal times the greater row


def test_copies_of_a_hot_id_are_combined_before_the_state(spark, tmp_path):
    inbox, mid, out = (str(tmp_path / n) for n in ("inbox", "mid", "out"))
    message_files(spark, inbox, [request(7) for _ in range(500)] + [request(8)])  # one source partition, one hot id
    stream = messages.requests(messages.parsed(source(spark, inbox))).select("UUID", "Timestamp")
    wait(jobs.combine_copies(stream, mid, str(tmp_path / "c1"), interval=None))
    combined = spark.read.parquet(mid).select("UUID", "Timestamp")
    assert rows(combined.select("UUID")) == [("u7",), ("u8",)]
    again = readers.message_stream(spark, "parquet", {}, combined.schema, f"{mid}/*/*")
    wait(jobs.to_files(jobs.unique_requests(again, "Timestamp", "1 hour"), out, str(tmp_path / "c2"), interval=None))
    assert rows(spark.read.parquet(out).select("UUID")) == [("u7",), ("u8",)]


def test_event_stream_reads_a_file_and_a_directory(spark, tmp_path, small):
    from skyledger import catalog
    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "dir" / "events.parquet"))
    for n, folder in enumerate((small, str(tmp_path / "dir"))):
        out = str(tmp_path / f"out{n}")
        wait(jobs.to_files(catalog._event_stream(spark, folder), out, str(tmp_path / f"c{n}"), interval=None))
        assert spark.read.parquet(out).count() == events.count()


def test_unanswered_requests_come_out_after_the_watermark(spark, tmp_path):
    asked_in, answers_in, out = (str(tmp_path / n) for n in ("asked", "answers", "out"))

    def stamps(path, *pairs):
        made = [(key, START + dt.timedelta(minutes=m)) for key, m in pairs]
        spark.createDataFrame(made, "UUID string, t timestamp").coalesce(1).write.mode("append").parquet(path)

    schema = spark.createDataFrame([], "UUID string, t timestamp").schema

    def stream(path, name):
        return readers.message_stream(spark, "parquet", {}, schema, path).withColumnRenamed("t", name)

    def run():
        paired = jobs.request_response(stream(asked_in, "asked"), stream(answers_in, "answered"), "asked", "answered",
                                       "10 MINUTES", "5 minutes", "left_outer")
        wait(jobs.to_files(paired.select("request_uuid", "response_uuid"), out, str(tmp_path / "c"), interval=None))

    stamps(asked_in, ("a", 0), ("a", 0), ("b", 0), ("late", 0))
    stamps(answers_in, ("a", 1), ("late", 11), ("a", 1))
    run()
    assert rows(spark.read.parquet(out)) == [("a", "a")]
    stamps(asked_in, ("z", 120))
    stamps(answers_in, ("z", 121))
    run()
    stamps(asked_in, ("zz", 240))
    stamps(answers_in, ("zz", 241))
    run()
    got = rows(spark.read.parquet(out))
    assert {("a", "a"), ("b", None), ("late", None), ("z", "z")} <= set(got) and len(got) == len(set(got))


def test_answers_outside_the_bound_do_not_hide_one_inside(spark, tmp_path):
    """A request at 100 s, its answers read in the order 5,000 s and 110 s, bound 10 minutes: the answer at 110 s."""
    asked_in, answers_in, out = (str(tmp_path / n) for n in ("asked", "answers", "out"))
    at = lambda seconds: START + dt.timedelta(seconds=seconds)
    spark.createDataFrame([("a", at(100)), ("a", at(100)), ("b", at(100))], "UUID string, asked timestamp").write.parquet(asked_in)
    schema = "UUID string, answered timestamp, Prediction double"

    def answer(*rows_):
        spark.createDataFrame([(u, at(s), p) for u, s, p in rows_], schema).coalesce(1).write.mode("append").parquet(answers_in)

    def run():
        asked = readers.message_stream(spark, "parquet", {}, spark.read.parquet(asked_in).schema, asked_in)
        answers = readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, spark.read.parquet(answers_in).schema, answers_in)
        paired = jobs.request_response(asked, answers, "asked", "answered", "10 MINUTES", "2 hours")
        wait(jobs.to_files(paired.select("request_uuid", "answered", "Prediction"), out, str(tmp_path / "c"), interval=None))

    answer(("a", 5000, 9.0), ("b", 701, 8.0))
    run()
    assert spark.read.parquet(out).count() == 0
    answer(("a", 300, 3.0))
    answer(("a", 110, 1.0), ("a", 110, 1.0), ("b", 700, 7.0))
    run()
    pairs = spark.read.parquet(out)
    assert pairs.count() == 3  # copies of an answer once, different answers each
    want = [("a", at(110), 1.0), ("b", at(700), 7.0)]
    got = jobs.first_answers(pairs, "answered")
    assert [(r.request_uuid, r.answered.replace(tzinfo=None), r.Prediction) for r in got.orderBy("request_uuid").collect()] == [
        (u, t.replace(tzinfo=None), p) for u, t, p in want]


def latest_run(spark, tmp_path, batches, **options):
    inbox, checkpoint, pushed = (str(tmp_path / n) for n in ("inbox", "checkpoint", "pushed"))
    schema = "uuid string, timestamp string, prediction double, at timestamp"
    for batch in batches:
        made = [(u, f"t{s:05}", p, START + dt.timedelta(seconds=s)) for u, s, p in batch]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, spark.read.parquet(inbox).schema, inbox)
        latest = jobs.latest_answers(stream, ["uuid"], ["timestamp"], **options)
        wait(jobs.keep_latest(latest, writers.row_log(pushed), checkpoint, interval=None))
    state = keyed.state_table(spark, checkpoint, ["uuid"], ["timestamp"])
    return rows(state.select("uuid", "timestamp", "prediction")), spark.read.parquet(pushed), checkpoint


def test_latest_is_in_the_state(spark, tmp_path):
    batches = [[("a", 10, 1.0), ("a", 5, 0.0), ("b", 7, 2.0)], [("a", 3, 9.0)], [("a", 10, 1.0), ("c", 1, 4.0)], [("b", 700, 3.0)], [("b", 7, 2.0)]]
    got, pushed, checkpoint = latest_run(spark, tmp_path, batches)
    assert got == [("a", "t00010", 1.0), ("b", "t00700", 3.0), ("c", "t00001", 4.0)]
    assert pushed.where("uuid = 'a'").select("prediction").distinct().collect()[0][0] == 1.0  # late and repeated answers push what is latest
    # A read looks at the state only: as many rows as ids, however many micro-batches there were.
    assert spark.read.format("statestore").load(checkpoint).count() == 3


def test_windows_bound_the_state(spark, tmp_path):
    day = 86_400
    batches = [[("a", 10, 1.0), ("b", 10, 2.0)], [("a", 20, 3.0)], [("b", 9 * day, 4.0)], [("c", 20 * day, 5.0)], [("c", 20 * day + 1, 6.0)]]
    got, _, _ = latest_run(spark, tmp_path, batches, time="at", keep="2 days")
    assert got == [("c", f"t{20 * day + 1:05}", 6.0)]


def test_console_and_interval(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    message_files(spark, inbox, [request(0)])
    wait(jobs.to_console(messages.rejects(messages.parsed(source(spark, inbox))), str(tmp_path / "c"), interval=None))
    seen = []
    query = jobs.per_batch(source(spark, inbox), lambda df, i: seen.append(df.count()), str(tmp_path / "d"), "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(seen) == 1


def test_parsed_request_fields(spark):
    df = spark.createDataFrame([(request(3, Prediction="9", Carrier_index=2.0),)], "value string")
    parsed = messages.parsed(df)
    flat = messages.requests(parsed)
    assert flat.columns == list(messages.REQUEST_FIELDS) and "FlightNum" not in flat.columns
    assert messages.requests(parsed, with_indices=True).first().Carrier_index == 2.0
    assert flat.select(times.iso_text(F.col("Timestamp"))).first()[0] == "2016-12-25T00:00:03.000000"
    assert message_functions.render("UUID") is not None


def test_messages_are_not_kept_beside_their_scores(spark, model, tmp_path):
    """Only scored rows are held while the sinks write; every odd message is either scored or rejected, never both."""
    odd = ["{bad", '{"Carrier":"AA"}', '{"UUID":null}', '[{"UUID":"in"}]', '{"UUID":"x1","DepDelay":"abc"}', '{"UUID":"x2","DepDelay":{"a":1}}', "", "7",
           '{"UUID":"x3","Timestamp":"nope","FlightDate":"nope"}', '{"UUID":"x4","Origin":"AT', '{"UUID":5}', '{"UUID":"x5"} tail', '{"UUID":{"a":1}}']
    inbox, log, held = str(tmp_path / "inbox"), str(tmp_path / "log"), []
    message_files(spark, inbox, [request(i) for i in range(20)] + odd)
    at_start, rejects = spark.sparkContext._jsc.getPersistentRDDs().size(), writers.row_log(str(tmp_path / "rejects"))

    def rejected(batch, batch_id):
        rejects(batch, batch_id)
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size() - at_start)

    wait(jobs.score_stream(source(spark, inbox), model, [writers.row_log(log)], str(tmp_path / "checkpoint"), reject_sink=rejected, interval=None))
    assert held == [1]
    kept = messages.parsed(spark.read.parquet(inbox)).localCheckpoint()  # every message parsed with all its fields
    assert rows(spark.read.parquet(str(tmp_path / "rejects")).select("value")) == rows(kept.where("flight.UUID IS NULL").select("value"))
    assert rows(spark.read.parquet(log).select("UUID")) == rows(kept.where("flight.UUID IS NOT NULL").select("flight.UUID"))
