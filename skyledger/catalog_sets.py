"""Registered queries on whole tables of requests, on layouts that serve them, and on streams that stop and go on.

They add to ``catalog``; dates and times are text here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import fixtures, schemas, session
from skyledger.catalog import (_LATEST_SQL, _MICROS, _PAGE_COLUMNS, _distances, _event_stream, _finished, _flights, _md5_bucket, _messages, _once,
                               _repeated, _response_messages, _response_rows, _trained, _typed_requests, query)
from skyledger.functions import forms, messages, times, variants
from skyledger.operators import aggregates, batch_search, directory, joins, lookups, search
from skyledger.plans import day_pages as day_plan
from skyledger.plans import encoding, features, forest_table, scoring, training
from skyledger.sources import bucketed, keyed, layout, readers, writers
from skyledger.streaming import jobs
from skyledger.streaming import messages as stream_messages

# --- searches for many requests ---------------------------------------------------------------------------------------

# Requests of all masks: bit i of ``event_id % 64`` tells whether field i is given, ten values for each, every third page.
_ASKED = {
    "Carrier": "concat('Brand#', {v} + 3)", "FlightDate": "CAST(CAST('1996-02-03' AS DATE) + CAST({v} * 41 AS INT) AS {text})",
    "Origin": "concat('NATION_', {v} * 2)", "Dest": "concat('NATION_', {v} + 4)", "TailNum": "concat('Supplier#00000000', {v})",
    "FlightNum": "CAST(1000 + {v} * 17 AS {text})",
}


def _asked_fields(text: str) -> list[tuple[str, str]]:
    """Each field and its SQL: the value where its bit is set, else null or an empty text."""
    value = "(event_id // 64 % 10)" if text == "VARCHAR" else "(event_id div 64 % 10)"
    return [(name, f"CASE WHEN (event_id % 64) & {1 << i} <> 0 THEN {sql.format(v=value, text=text)} WHEN event_id % 2 = 0 THEN '' END")
            for i, (name, sql) in enumerate(_ASKED.items())]


_MANY_SQL = f"""
SELECT * FROM (WITH asked AS MATERIALIZED (
 SELECT event_id AS request, CAST(event_id % 3 * 10 AS INT) AS "start", {', '.join(f"coalesce({sql}, '') AS q{name}" for name, sql in _asked_fields('VARCHAR'))}
 FROM events),
named AS MATERIALIZED (SELECT *, concat_ws('|', {', '.join(f'q{name}' for name in _ASKED)}) AS c FROM asked),
criteria AS MATERIALIZED (SELECT DISTINCT c, {', '.join(f'q{name}' for name in _ASKED)} FROM named),
pool AS MATERIALIZED (
 SELECT Carrier || '' AS Carrier, FlightDate || '' AS FlightDate, Origin || '' AS Origin, Dest || '' AS Dest, TailNum || '' AS TailNum,
  FlightNum || '' AS FlightNum, CRSDepTime || '' AS CRSDepTime, row_key || '' AS row_key FROM flights),
hits AS MATERIALIZED (
 SELECT c, Carrier, FlightDate, CRSDepTime, FlightNum, row_key, count(*) OVER (PARTITION BY c) AS n,
  row_number() OVER (PARTITION BY c ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key) AS p
 FROM criteria JOIN pool f ON {' AND '.join(f"(q{name} = '' OR q{name} = f.{name})" for name in _ASKED)}),
total AS MATERIALIZED (SELECT c, max(n) AS n FROM hits GROUP BY c),
shown AS MATERIALIZED (SELECT * FROM hits WHERE p <= 30)
SELECT request, "start", coalesce(total.n, 0) AS hit_count, CAST(p AS INT) AS position, Carrier, FlightDate, CRSDepTime AS DepTime, FlightNum, row_key
FROM named LEFT JOIN total ON total.c = named.c
LEFT JOIN shown ON shown.c = named.c AND p > "start" AND p <= "start" + 10)"""


@query("flights", sql=_MANY_SQL)
def flight_search_many(spark, sf_dir):
    """A page for each of many requests with all 64 choices of fields, absent ones null or empty."""
    events = fixtures.table(spark, sf_dir, "events")
    asked = events.select(F.col("event_id").alias("request"), F.expr("CAST(event_id % 3 * 10 AS INT)").alias("start"),
                          *[F.expr(sql).alias(name) for name, sql in _asked_fields("STRING")])
    found = batch_search.search_many(_flights(spark, sf_dir), asked, schemas.FLIGHT_SEARCH_FIELDS, search.FLIGHT_ORDER, ("row_key",))
    return found.select("request", "start", "hit_count", "position", "Carrier", "FlightDate", "DepTime", "FlightNum", "row_key")


@query("airplanes", sql="""
SELECT * FROM (WITH asked AS MATERIALIZED (
 SELECT event_id AS request, CASE event_id % 4 WHEN 0 THEN 'brand' WHEN 1 THEN concat('x ', event_id % 25, ' ', event_id % 7) ELSE '' END AS qManufacturer,
  CASE event_id % 3 WHEN 0 THEN 'economy, standard' WHEN 1 THEN 'promo' ELSE '' END AS qModel,
  CASE WHEN event_id % 5 = 0 THEN concat('NATION_', event_id % 25) ELSE '' END AS qState,
  CASE WHEN event_id % 7 = 0 THEN CAST(1971 + event_id % 50 AS VARCHAR) ELSE '' END AS qYear FROM events),
named AS MATERIALIZED (SELECT *, concat_ws('|', qManufacturer, qModel, qState, qYear) AS c FROM asked),
criteria AS MATERIALIZED (SELECT DISTINCT c, qManufacturer, qModel, qState, qYear FROM named),
hits AS MATERIALIZED (
 SELECT c, a.TailNum, a.Owner, count(*) OVER (PARTITION BY c) AS n, row_number() OVER (PARTITION BY c ORDER BY Owner, TailNum) AS p
 FROM criteria JOIN airplanes a ON
  (qManufacturer = '' OR list_has_any(regexp_split_to_array(lower(Manufacturer), '[^a-z0-9_]+'), regexp_split_to_array(qManufacturer, '[^a-z0-9_]+')))
  AND (qModel = '' OR list_has_any(regexp_split_to_array(lower(Model), '[^a-z0-9_]+'), regexp_split_to_array(qModel, '[^a-z0-9_]+')))
  AND (qState = '' OR qState = OwnerState) AND (qYear = '' OR qYear = CAST(ManufacturerYear AS VARCHAR))),
total AS MATERIALIZED (SELECT c, max(n) AS n FROM hits GROUP BY c),
shown AS MATERIALIZED (SELECT * FROM hits WHERE p <= 3)
SELECT request, coalesce(total.n, 0) AS airplane_count, CAST(p AS INT) AS position, TailNum, Owner
FROM named LEFT JOIN total ON total.c = named.c LEFT JOIN shown ON shown.c = named.c)""")
def airplane_search_many(spark, sf_dir):
    """Requests whose words match any word of two of the nine fields, in any case."""
    asked = fixtures.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request"),
        F.expr("CASE event_id % 4 WHEN 0 THEN 'brand' WHEN 1 THEN concat('x ', event_id % 25, ' ', event_id % 7) END").alias("Manufacturer"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'Economy, standard' WHEN 1 THEN 'PROMO' END").alias("Model"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN concat('NATION_', event_id % 25) END").alias("OwnerState"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN CAST(1971 + event_id % 50 AS STRING) END").alias("ManufacturerYear"))
    found = batch_search.search_many(
        fixtures.airplanes(spark, sf_dir), asked, schemas.AIRPLANE_SEARCH_FIELDS, search.AIRPLANE_ORDER, ("TailNum",),
        words=("Manufacturer", "Model"), size=3, count_name="airplane_count")
    return found.select("request", "airplane_count", "position", "TailNum", "Owner")


def _asked_routes(spark, sf_dir) -> DataFrame:
    return fixtures.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request"), F.expr("concat('NATION_', event_id % 25)").alias("Origin"),
        F.expr("concat('NATION_', user_id % 25)").alias("Dest"),
        F.expr("CAST(date_add(DATE '1995-01-01', CAST(event_id % 500 AS INT)) AS STRING)").alias("FlightDate"))


@query("flights", sql="""
SELECT * FROM (WITH asked AS (
 SELECT event_id AS request, concat('NATION_', event_id % 25) AS Origin, concat('NATION_', user_id % 25) AS Dest,
  CAST(DATE '1995-01-01' + CAST(event_id % 500 AS INT) AS VARCHAR) AS FlightDate FROM events),
numbered AS (
 SELECT *, count(*) OVER (PARTITION BY Origin, Dest, FlightDate) AS n,
  row_number() OVER (PARTITION BY Origin, Dest, FlightDate ORDER BY CRSDepTime, CRSArrTime, row_key) AS p FROM flights)
SELECT request, a.Origin, a.Dest, a.FlightDate, coalesce(n, 0) AS flight_count, CAST(p AS BIGINT) AS position, Carrier, FlightNum, CRSDepTime AS DepTime, row_key
FROM asked a LEFT JOIN numbered f ON a.Origin = f.Origin AND a.Dest = f.Dest AND a.FlightDate = f.FlightDate)""")
def route_day_many(spark, sf_dir):
    """All flights of each asked route and day in the order of its page, with their number; a route without flights keeps a row."""
    def make() -> str:
        path = session.work_folder(spark, "route_days")
        directory.write_numbered(_flights(spark, sf_dir), path, ("Origin", "Dest", "FlightDate"), ("DepTime", "ArrTime", "row_key"), 1 << 17)
        return path
    key = ["Origin", "Dest", "FlightDate"]
    flights = directory.numbered(spark, _once(spark, sf_dir, "route_days", make), key)
    pages = _asked_routes(spark, sf_dir).join(flights, key, "left")
    return pages.select("request", *key, F.coalesce("position_of", F.lit(0)).alias("flight_count"), "position", "Carrier", "FlightNum", "DepTime", "row_key")


# --- pages by number --------------------------------------------------------------------------------------------------

_PAGE_ORDER = (*search.FLIGHT_ORDER, "row_key")
_DEEP_SQL = """
SELECT Carrier, FlightNum, Origin, Dest, FlightDate, CRSDepTime AS DepTime, TailNum, Distance / 8 AS AirTime, Distance, row_key,
 CAST(row_number() OVER (ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key) AS BIGINT) AS position
FROM flights WHERE {where} ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key
LIMIT 10 OFFSET (SELECT count(*) * 3 // 4 FROM flights WHERE {where})"""


def _ordered(spark, sf_dir) -> str:
    """Folder of the flights in the order of the search page."""
    def make() -> str:
        path = session.work_folder(spark, "ordered")
        directory.write_ordered(_flights(spark, sf_dir).select(*_PAGE_COLUMNS), path, _PAGE_ORDER, 1 << 13)
        return path
    return _once(spark, sf_dir, "ordered", make)


@query("flights", sql=_DEEP_SQL.format(where="true"))
def flight_page_deep(spark, sf_dir):
    """The page three quarters down the whole table."""
    path = _ordered(spark, sf_dir)
    rows = directory.directory_of(spark, path).agg(F.sum("rows")).first()[0]
    return directory.page(spark, path, _PAGE_ORDER, rows * 3 // 4, 10)


@query("flights", sql=_DEEP_SQL.format(where="Origin = 'NATION_3'"))
def flight_page_deep_filtered(spark, sf_dir):
    """The page three quarters down the hits of a search."""
    path, condition = _ordered(spark, sf_dir), F.col("Origin") == "NATION_3"
    hits = directory.directory_of(spark, path, condition).agg(F.sum("rows")).first()[0]
    return directory.page(spark, path, _PAGE_ORDER, hits * 3 // 4, 10, condition)


@query("flights", sql="""
SELECT request, "start", position, row_key FROM (SELECT event_id AS request, event_id * 997 % 70000 AS "start" FROM events WHERE event_type = 'click') r
JOIN (SELECT row_key, CAST(row_number() OVER (ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key) AS BIGINT) AS position FROM flights) f
 ON position > "start" AND position <= "start" + 10""")
def flight_pages_many(spark, sf_dir):
    """Pages anywhere in the table, and behind its end, for many requests."""
    asked = fixtures.table(spark, sf_dir, "events").where("event_type = 'click'").select(
        F.col("event_id").alias("request"), F.expr("event_id * 997 % 70000").alias("start"))
    return directory.pages(spark, _ordered(spark, sf_dir), asked, 10).select("request", "start", "position", "row_key")


# --- layouts ----------------------------------------------------------------------------------------------------------

# One value per search field, each used as the only filter.
_SINGLE = {"Carrier": "Brand#7", "FlightDate": "1998-05-05", "Origin": "NATION_3", "Dest": "NATION_4", "TailNum": "Supplier#000000003", "FlightNum": "1042"}


def _z_ordered(spark, sf_dir) -> DataFrame:
    def make() -> str:
        path = session.work_folder(spark, "z_ordered")
        flights = _flights(spark, sf_dir)
        layout.write_z_ordered(flights, path, schemas.FLIGHT_SEARCH_FIELDS, files=64)
        return path
    return spark.read.parquet(_once(spark, sf_dir, "z_ordered", make))


@query("flights", sql=" UNION ALL ".join(
    f"SELECT '{name}' AS field, count(*) AS hits, sum(Distance) AS distance, min(row_key) AS first_key FROM flights WHERE {name} = '{value}'"
    for name, value in _SINGLE.items()))
def search_any_field(spark, sf_dir):
    """A search by each field alone, on the table whose layout prunes for all of them."""
    table = _z_ordered(spark, sf_dir)
    found = [table.where(F.col(name) == value).agg(F.count(F.lit(1)).alias("hits"), F.sum("Distance").alias("distance"), F.min("row_key").alias("first_key"))
             .select(F.lit(name).alias("field"), "hits", "distance", "first_key") for name, value in _SINGLE.items()]
    result = found[0]
    for further in found[1:]:
        result = result.unionByName(further)
    return result


def _buckets(spark) -> int:
    return max(4, spark.sparkContext.defaultParallelism)


@query("requests", "distances", sql="""
SELECT r.UUID, r.Origin, r.Dest, coalesce(d.Distance, 0) AS Distance FROM requests r LEFT JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest""")
def distance_bucket_join(spark, sf_dir):
    """Distances for requests from a table in buckets of the route; the requests are moved, the distances are not."""
    path = session.work_folder(spark, "distance-buckets")
    table = bucketed.write(_distances(spark, sf_dir), path, f"distances_{path.rsplit('-', 1)[1]}", joins.ROUTE_KEY, _buckets(spark), spread=2)
    asked = fixtures.requests(spark, sf_dir).select("UUID", "Origin", "Dest")
    return bucketed.joined(asked, table, joins.ROUTE_KEY).withColumn("Distance", F.coalesce("Distance", F.lit(0.0)))


@query("requests", "responses", sql="""
SELECT r.UUID, r.Carrier, p.Prediction, CASE WHEN p.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status
FROM requests r LEFT JOIN (SELECT UUID, max_by(Prediction, ResponseTime) AS Prediction FROM responses GROUP BY UUID) p ON r.UUID = p.UUID""")
def response_bucket_status(spark, sf_dir):
    """The status of requests, both sides in buckets of the id: no row is exchanged."""
    path = session.work_folder(spark, "response-buckets")
    name = path.rsplit("-", 1)[1]
    answers = _response_rows(fixtures.table(spark, sf_dir, "events"))
    latest = keyed.combined([answers.select("UUID", "ResponseTime", "Prediction")], ["UUID"], ["ResponseTime"])
    table = bucketed.write(latest, f"{path}/responses", f"responses_{name}", ["UUID"], _buckets(spark))
    asked = bucketed.write(fixtures.requests(spark, sf_dir).select("UUID", "Carrier"), f"{path}/requests", f"requests_{name}", ["UUID"], _buckets(spark))
    found = bucketed.joined(asked, table, ["UUID"])
    return found.select("UUID", "Carrier", "Prediction", F.when(F.col("ResponseTime").isNull(), "WAIT").otherwise("OK").alias("status"))


# --- streams that stop and go on --------------------------------------------------------------------------------------

@query("responses", sql=_LATEST_SQL)
def latest_answers_state(spark, sf_dir):
    """Answers of two writers, some sent twice and some late: the latest per id, read from the state of one streaming aggregate."""
    path, checkpoint = session.work_folder(spark, "answers"), session.work_folder(spark, "answers-checkpoint")
    sent = keyed.response_rows(_response_messages(_response_rows(fixtures.table(spark, sf_dir, "events"))))
    late = F.pmod(F.xxhash64("uuid"), F.lit(3)) == 0

    def answer() -> None:
        writers_ = [readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "2"}, sent.schema, f"{path}/{name}") for name in ("first", "second")]
        latest = jobs.latest_answers(writers_[0].unionByName(writers_[1]), keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
        jobs.keep_latest(latest, writers.message_log(f"{path}/pushed"), checkpoint, interval=None, partitions=_buckets(spark)).awaitTermination()

    sent.where(~late).repartition(3).write.parquet(f"{path}/first")
    sent.where("dayofmonth % 2 = 0").repartition(2).write.parquet(f"{path}/second")
    answer()
    sent.repartition(2).write.mode("append").parquet(f"{path}/second")
    answer()
    return keyed.state_table(spark, checkpoint, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER).select(*sent.columns)


@query("requests", sql=f"""
SELECT UUID, Carrier, strftime("Timestamp", {_MICROS}) AS "Timestamp",
 event_id < (SELECT count(*) // 2 FROM events) AS before_restart FROM requests""")
def stream_restart(spark, sf_dir):
    """A stateful stream in small micro-batches that is stopped half-way and started again from its checkpoint.

    The second half repeats a part of the first, so what comes out is right only if the state came along. Which ids were known at
    the stop is read from the state.
    """
    events = fixtures.table(spark, sf_dir, "events")
    half = events.count() // 2
    path, out, checkpoint = (session.work_folder(spark, name) for name in ("restart-in", "restart-out", "restart-checkpoint"))

    def go_on() -> None:
        stream = readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, events.schema, path)
        rows = _repeated(fixtures.request_rows(stream).select("UUID", "Carrier", "Timestamp"))
        unique = jobs.unique_requests(rows, "Timestamp", "400 days")
        jobs.to_files(unique, out, checkpoint, interval=None, partitions=_buckets(spark)).awaitTermination()

    events.where(F.col("event_id") < half).repartitionByRange(3, "event_id").write.parquet(path)
    go_on()
    # Reading the state now and keeping what it says: later batches change it.
    known = session.work_folder(spark, "restart-known")
    spark.read.format("statestore").load(checkpoint).select(F.col("key.UUID").alias("UUID"), F.lit(True).alias("_known")).write.parquet(known)
    events.where(F.col("event_id") >= half // 2).repartitionByRange(3, "event_id").write.mode("append").parquet(path)
    go_on()
    rows = spark.read.parquet(out).join(spark.read.parquet(known), "UUID", "left")
    return rows.select("UUID", "Carrier", times.iso_text(F.col("Timestamp")).alias("Timestamp"), F.coalesce("_known", F.lit(False)).alias("before_restart"))


# --- page tables by day, documents, sketches and counts on the way ----------------------------------------------------

@query("flights", sql="""
SELECT 'month' AS page, concat("Year", '-', "Month") AS key, count(*) AS value FROM flights WHERE FlightDate <> '1997-02-03' GROUP BY "Year", "Month"
UNION ALL SELECT 'airplane', TailNum, count(*) FROM flights WHERE FlightDate <> '1997-02-03' GROUP BY TailNum
UNION ALL SELECT 'carrier', Carrier, count(DISTINCT TailNum) FROM flights WHERE FlightDate <> '1997-02-03' GROUP BY Carrier""")
def day_pages(spark, sf_dir):
    """Pages merged from the states of days: half of a month arrives late, one day becomes empty, and an update is repeated."""
    base = session.work_folder(spark, "day-pages")
    flights = _flights(spark, sf_dir).select("FlightDate", "Year", "Month", "Carrier", "TailNum", "row_key")
    late, empty = F.col("FlightDate").startswith("1998-05"), F.col("FlightDate") == "1997-02-03"
    day_plan.update(spark, base, flights.where(~late | (F.pmod(F.xxhash64("row_key"), F.lit(2)) == 0)))
    for _ in range(2):
        day_plan.update(spark, base, flights.where(late))
    day_plan.update(spark, base, flights.where(empty & F.lit(False)), spark.sql("SELECT DATE '1997-02-03' AS dt"))
    months, planes, fleets = day_plan.flights_by_month(spark, base), day_plan.flights_per_airplane(spark, base), day_plan.fleet_counts(spark, base)
    named = lambda df, page, key, value: df.select(F.lit(page).alias("page"), key.alias("key"), F.col(value).alias("value"))
    return named(months, "month", F.concat_ws("-", "Year", "Month"), "total_flights").unionByName(
        named(planes, "airplane", F.col("TailNum"), "FlightCount")).unionByName(named(fleets, "carrier", F.col("Carrier"), "FleetCount"))


@query("flights", sql="""
SELECT Carrier, count(DISTINCT TailNum) AS FleetCount, true AS within_error FROM flights WHERE FlightDate >= '1996-01-01' GROUP BY Carrier""")
def fleet_estimates(spark, sf_dir):
    """Fleets of some days from merged sketches, beside the exact ones: within three standard deviations of the sketch."""
    base = session.work_folder(spark, "fleet-states")
    flights = _flights(spark, sf_dir)
    day_plan.update(spark, base, flights)
    exact = flights.where("FlightDate >= '1996-01-01'").groupBy("Carrier").agg(F.count_distinct("TailNum").alias("FleetCount"))
    guessed = day_plan.fleet_estimates(spark, base, F.col("dt") >= F.lit("1996-01-01").cast("date"))
    off = F.abs(F.col("estimate") - F.col("FleetCount")) <= F.greatest(F.lit(0.5), F.col("FleetCount") * day_plan.sketch_error())
    return exact.join(guessed, "Carrier", "left").select("Carrier", "FleetCount", F.coalesce(off, F.lit(False)).alias("within_error"))


_DOCUMENT_SQL = """CASE event_type WHEN 'click' THEN concat('{{"id":', event_id, ',"value":', value, ',"user":', user_id, '}}')
 WHEN 'view' THEN concat('{{"id":"e', event_id, '","user":{{"id":', user_id, '}},"tags":["t', event_id % 7, '","x"]}}')
 WHEN 'error' THEN {bad} ELSE concat('{{"id":', event_id, ',"value":"', value, '","note":null}}') END"""


@query(sql="""
SELECT event_id, CASE WHEN event_type = 'view' THEN concat('e', event_id) WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS id,
 CASE event_type WHEN 'click' THEN user_id WHEN 'view' THEN user_id END AS "user", CASE WHEN event_type = 'view' THEN concat('t', event_id % 7) END AS first_tag,
 CASE WHEN event_type <> 'view' AND event_type <> 'error' THEN value END AS value, event_type NOT IN ('click', 'view', 'error') AS has_note,
 event_type = 'error' AS rejected FROM events""")
def variant_documents(spark, sf_dir):
    """Documents whose fields differ in presence, type and depth: written as they are, read again, and asked by path."""
    path = session.work_folder(spark, "variants")
    events = fixtures.table(spark, sf_dir, "events")
    texts = events.select("event_id", F.expr(_DOCUMENT_SQL.format(bad="concat('{\"id\":', event_id)").replace("{{", "{").replace("}}", "}")).alias("text"))
    texts.withColumn("document", variants.parsed(F.col("text"))).write.parquet(path)
    read = spark.read.parquet(path)
    document = F.col("document")
    user = F.coalesce(variants.taken(document, "$.user.id", "bigint"), variants.taken(document, "$.user", "bigint"))
    return read.select(
        "event_id", variants.taken(document, "$.id", "string").alias("id"), user.alias("user"), variants.taken(document, "$.tags[0]", "string").alias("first_tag"),
        variants.taken(document, "$.value", "double").alias("value"), variants.has(document, "$.note").alias("has_note"),
        (F.col("text").isNotNull() & document.isNull()).alias("rejected"))


@query(sql="""
SELECT event_type, field, count(*) AS documents FROM events, (VALUES ('click', 'id'), ('click', 'value'), ('click', 'user'), ('view', 'id'), ('view', 'user'),
 ('view', 'tags'), ('', 'id'), ('', 'value'), ('', 'note')) f(kind, field)
WHERE event_type <> 'error' AND kind = CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE '' END GROUP BY ALL""")
def variant_fields(spark, sf_dir):
    """Which fields the documents of each kind have, and how often."""
    events = fixtures.table(spark, sf_dir, "events")
    text = F.expr(_DOCUMENT_SQL.format(bad="'not json'").replace("{{", "{").replace("}}", "}"))
    found = variants.fields(events.select("event_type", variants.parsed(text).alias("document")), "document", ("event_type",))
    return found.groupBy("event_type", "field").agg(F.count(F.lit(1)).alias("documents"))


@query("flights", sql="""
SELECT i AS edge, (SELECT count(ArrDelay) FROM flights) AS known, true AS within_error, true AS ascending FROM (SELECT unnest(range(1, 10)) AS i)""")
def delay_equal_depth(spark, sf_dir):
    """Edges of ten buckets of equal size from one sketch; each misses its exact rank by no more than the stated error."""
    flights = _flights(spark, sf_dir)
    edges = flights.limit(1).select(aggregates.equal_depth_edges(flights, "ArrDelay", 10).alias("edges")).first().edges
    delay, places = F.col("ArrDelay"), range(len(edges))
    counted = flights.agg(F.count("ArrDelay").alias("known"), *[F.count_if(delay < edges[i]).alias(f"below_{i}") for i in places],
                          *[F.count_if(delay <= edges[i]).alias(f"upto_{i}") for i in places]).first()
    slack = aggregates.rank_error(800) * counted.known + 1
    rows = [(i + 1, counted.known, counted[f"below_{i}"] - slack <= counted.known * (i + 1) / 10 <= counted[f"upto_{i}"] + slack,
             i == 0 or edges[i - 1] <= edges[i]) for i in places]
    return spark.createDataFrame(rows, "edge long, known long, within_error boolean, ascending boolean")


@query("flights", sql="""
SELECT sum(n) AS counted, min(lo) AS low, max(hi) AS high, true AS apart FROM (SELECT count(ArrDelay) AS n, min(ArrDelay) AS lo, max(ArrDelay) AS hi FROM flights)""")
def delay_equal_depth_histogram(spark, sf_dir):
    """The histogram counts every known value once, in buckets that do not overlap."""
    made = aggregates.histogram_equal_depth(_flights(spark, sf_dir), "ArrDelay", 10)
    before = F.lag("high").over(W.orderBy("label"))  # ten rows
    return made.withColumn("_apart", F.coalesce(before < F.col("low"), F.lit(True))).agg(
        F.sum("value").alias("counted"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("_apart").alias("apart"))


_OBSERVED = ["ArrDelay", "Carrier", "DepDelay", "WeatherDelay"]


@query("flights", sql=" UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count, count(*) AS row_count FROM flights" for name in _OBSERVED))
def observed_write(spark, sf_dir):
    """Rows and nulls, counted while the table is written."""
    path = session.work_folder(spark, "observed")
    rows, nulls = writers.write_observed(_flights(spark, sf_dir).select(*_OBSERVED), lambda df: writers.write_parquet(df, path), _OBSERVED)
    return spark.createDataFrame([(name, count, rows) for name, count in nulls.items()], "column_name string, null_count long, row_count long")


# --- models whose results SQL can state -------------------------------------------------------------------------------

@query("features", sql="""
SELECT * FROM (WITH f AS (SELECT row_key, Origin || '-' || Dest AS Route, ArrDelay, """ + _md5_bucket("row_key", "5") + """ AS fold FROM features),
 w AS (SELECT *, sum(ArrDelay) OVER (PARTITION BY Route) - sum(ArrDelay) OVER (PARTITION BY Route, fold) AS s,
  count(*) OVER (PARTITION BY Route) - count(*) OVER (PARTITION BY Route, fold) AS n,
  (sum(ArrDelay) OVER () - sum(ArrDelay) OVER (PARTITION BY fold)) / (count(*) OVER () - count(*) OVER (PARTITION BY fold)) AS prior FROM f)
SELECT row_key, fold, round((s + 20 * prior) / (n + 20), 6) AS encoded FROM w)""")
def target_encoding(spark, sf_dir):
    """The mean delay of each route, for every flight from the folds it is not in."""
    known = training.with_route(_flights(spark, sf_dir)).where("ArrDelay IS NOT NULL AND DepDelay IS NOT NULL").select("row_key", "Route", "ArrDelay")
    fold = forms.hash_bucket(F.col("row_key"), 5)
    made = encoding.encoded_by_fold(known, ["Route"], "ArrDelay", fold, {"Route": "encoded"})
    return made.select("row_key", fold.alias("fold"), F.round("encoded", 6).alias("encoded"))


@query("requests", "features", sql="""
SELECT UUID, r.Origin, round(m.mean, 2) AS Delay FROM requests r JOIN (SELECT Origin, avg(ArrDelay) AS mean FROM features GROUP BY Origin) m ON r.Origin = m.Origin""")
def regression_by_origin(spark, sf_dir):
    """Predicted delays of a line that knows the origin only: least squares then gives each origin its mean."""
    model = training.train_regression(features.extract(_flights(spark, sf_dir)), ["Origin"], [], max_iter=300, regularisation=0.0, tolerance=1e-14)
    asked = fixtures.requests(spark, sf_dir).withColumns({name: F.lit(0) for name in training.REGRESSION_NUMERIC})
    known = asked.join(model.labels.select(F.col("label").alias("Origin")), "Origin", "left_semi")  # an origin without flights has no mean
    return training.score_regression(known, model).select("UUID", "Origin", F.round("Delay", 2).alias("Delay"))


@query("requests", sql="SELECT count(*) AS scored, CAST(0 AS BIGINT) AS differing, true AS several_classes FROM requests")
def forest_by_table(spark, sf_dir):
    """Classes of all requests by joins with the table of the forest's nodes, beside those of the chain: none differs."""
    path = _trained(spark, sf_dir)
    model, asked = training.load(spark, path), _typed_requests(spark, sf_dir)
    table = forest_table.nodes(spark, path)
    by_table = forest_table.classified(forest_table.feature_rows(asked, model, "UUID"), table, "UUID", forest_table.levels(table))
    by_chain = scoring.score(asked, model, "keep").select("UUID", F.col("Prediction").alias("chain"))
    return by_chain.join(by_table, "UUID", "full_outer").agg(
        F.count("Prediction").alias("scored"), F.count_if(~F.col("Prediction").eqNullSafe(F.col("chain"))).alias("differing"),
        (F.count_distinct("Prediction") > 1).alias("several_classes"))


# --- sinks and previews -----------------------------------------------------------------------------------------------

@query("requests", sql="""SELECT UUID, Carrier, strftime("Timestamp", {0}) AS "Timestamp" FROM requests""".format(_MICROS))
def collection_append(spark, sf_dir):
    """Requests appended to a table in two writes, as the request jobs do."""
    path = session.work_folder(spark, "collection")
    asked = fixtures.requests(spark, sf_dir).select("UUID", "Carrier", "Timestamp")
    half = F.col("UUID").cast("bigint") % 2 == 0
    for part in (asked.where(half), asked.where(~half)):
        writers.append(part, "parquet", path=path)
    return readers.collection(spark, "parquet", path=path).withColumn("Timestamp", times.iso_text(F.col("Timestamp")))


@query("requests", sql="""
SELECT UUID, Carrier, Origin, Dest FROM requests ORDER BY CAST(UUID AS BIGINT) LIMIT 6""")
def first_rows(spark, sf_dir):
    """The six rows a job shows of its result."""
    asked = fixtures.requests(spark, sf_dir).orderBy(F.col("UUID").cast("bigint"))
    return lookups.preview(asked.select("UUID", "Carrier", "Origin", "Dest"))


@query("requests", sql="""
SELECT count(*) FILTER (event_id % 3 = 1) AS accepted, count(*) FILTER (event_id % 3 <> 1) AS rejected, CAST(1 AS BIGINT) AS writes FROM requests""")
def stream_skips_empty_writes(spark, sf_dir):
    """Three micro-batches of which two hold rejects only: a single one is written to the sink."""
    path = session.work_folder(spark, "skips")
    rows = fixtures.request_rows(fixtures.table(spark, sf_dir, "events"))
    body = messages.render(F.when(F.col("UUID").cast("bigint") % 3 == 1, F.col("UUID")).alias("UUID"), "Carrier", "Origin", "Dest", "DepDelay")
    sent = rows.select((F.col("UUID").cast("bigint") % 3).alias("part"), body.cast("binary").alias("value"))
    for part in range(3):
        sent.where(F.col("part") == part).select("value").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, schemas.layout(value="string"), f"{path}/in")
    jobs.score_stream(stream.withColumn("value", F.col("value").cast("string")), training.load(spark, _trained(spark, sf_dir)), [writers.row_log(f"{path}/out")],
                      f"{path}/checkpoint", reject_sink=writers.row_log(f"{path}/rejects"), interval=None).awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    rejected = spark.read.parquet(f"{path}/rejects").agg(F.count(F.lit(1))).scalar()
    return out.agg(F.count(F.lit(1)).alias("accepted"), F.count_distinct("batch_id").alias("writes")).withColumn("rejected", rejected)


@query("requests", sql="""
SELECT count(*) AS parsed, true AS in_several_batches FROM requests WHERE event_id % 41 <> 0 AND event_id % 43 <> 0""")
def stream_by_interval(spark, sf_dir):
    """Messages read at an interval, two files each time, until all have been read."""
    path = session.work_folder(spark, "interval")
    _messages(fixtures.table(spark, sf_dir, "events")).repartition(4).write.parquet(f"{path}/in")
    stream = readers.message_stream(spark, "parquet", {"maxFilesPerTrigger": "2"}, T.StructType([T.StructField("value", T.BinaryType())]), f"{path}/in")
    parsed = stream_messages.requests(stream_messages.parsed(stream))
    running = jobs.per_batch(parsed, writers.row_log(f"{path}/out"), f"{path}/checkpoint", "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{path}/out").agg(F.count("UUID").alias("parsed"), (F.count_distinct("batch_id") > 1).alias("in_several_batches"))
