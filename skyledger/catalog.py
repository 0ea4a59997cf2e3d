"""Registered queries and, for each that SQL can express, an independent SQL text for the same result.

Dates and timestamps are returned as text and arrays as joined text, so that results compare by value across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import fixtures, schemas, session
from skyledger.functions import forms, messages, text, times
from skyledger.operators import aggregates, documents, joins, lookups, ordering, search
from skyledger.plans import daily, features, requests, scoring, training
from skyledger.sources import keyed, readers, writers
from skyledger.streaming import jobs
from skyledger.streaming import messages as stream_messages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# --- SQL of the derived tables ----------------------------------------------------------------------------------------

_FLIGHTS_SQL = """
SELECT p_brand AS Carrier, origin_name AS Origin, dest_name AS Dest, s_name AS TailNum,
 CAST(1000 + l_partkey % 5000 AS VARCHAR) AS FlightNum, CAST(d AS VARCHAR) AS FlightDate,
 CAST(year(d) AS INT) AS "Year", CAST(month(d) AS INT) AS "Month", CAST(day(d) AS INT) AS DayofMonth,
 CAST(isodow(d) AS INT) AS DayOfWeek, CAST(100 + 37 * ((sk * 7 + ck * 13) % 60) AS DOUBLE) AS Distance,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE delay END AS DepDelay,
 CASE WHEN l_linenumber = 7 OR (l_linenumber = 6 AND l_returnflag = 'R') THEN NULL ELSE delay + l_quantity - 25 END
   AS ArrDelay,
 lpad(CAST(dep_hm AS VARCHAR), 4, '0') AS CRSDepTime, lpad(CAST(arr_hm AS VARCHAR), 4, '0') AS CRSArrTime,
 CASE WHEN l_returnflag = 'R' THEN l_quantity END AS WeatherDelay,
 concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS row_key
FROM (
 SELECT l.*, s.s_name, s.s_nationkey AS sk, c.c_nationkey AS ck, sn.n_name AS origin_name, cn.n_name AS dest_name,
  p.p_brand, CAST(l.l_shipdate AS DATE) AS d,
  CAST((l.l_orderkey * 31 + l.l_partkey * 17 + l.l_linenumber * 7) % 180 AS DOUBLE) - 30 AS delay,
  CAST((l.l_orderkey % 24) * 100 + (l.l_partkey % 60) AS INT) AS dep_hm,
  CAST(((l.l_orderkey + 1 + l.l_suppkey % 5) % 25) * 100 + ((l.l_partkey + 17) % 60) AS INT) AS arr_hm
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN nation sn ON s.s_nationkey = sn.n_nationkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
 JOIN part p ON l.l_partkey = p.p_partkey)"""

_AIRPLANES_SQL = """
SELECT concat('N', p.p_partkey) AS TailNum, s.s_name AS Owner, n.n_name AS OwnerState, p.p_brand AS Manufacturer,
 p.p_type AS Model, CAST(1970 + p.p_size AS INT) AS ManufacturerYear, CAST(p.p_partkey AS VARCHAR) AS SerialNumber,
 p.p_name AS EngineManufacturer, concat('E', p.p_size) AS EngineModel
FROM part p JOIN supplier s ON s.s_suppkey = p.p_partkey % (SELECT count(*) FROM supplier)
JOIN nation n ON s.s_nationkey = n.n_nationkey"""

_AIRLINES_SQL = """
SELECT CarrierCode, 'Airline ' || CarrierCode AS Name, 'http://' || domain || '/' AS url, domain,
 'Summary of ' || CarrierCode AS summary, 'http://' || domain || '/logo.png' AS logo_url
FROM (SELECT DISTINCT CarrierCode, lower(replace(CarrierCode, '#', '')) || '.example.com' AS domain
 FROM (SELECT CASE WHEN p_brand = 'Brand#5' THEN 'Brand#505' ELSE p_brand END AS CarrierCode FROM part)
 WHERE CarrierCode NOT IN ('Brand#3', 'Brand#11'))"""

_REQUESTS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS UUID, ts AS "Timestamp", concat('Brand#', event_id % 26) AS Carrier,
 CASE WHEN event_id % 97 = 0 THEN 'NATION_99' ELSE concat('NATION_', event_id % 25) END AS Origin,
 concat('NATION_', user_id % 25) AS Dest, CAST(1000 + event_id % 5000 AS VARCHAR) AS FlightNum,
 CAST(CAST(ts AS DATE) AS VARCHAR) AS FlightDate, value AS DepDelay, event_id
FROM events"""

_RESPONSES_SQL = """
SELECT CAST(event_id AS VARCHAR) AS UUID, copy, ts + to_seconds(event_id % 900 + copy) AS ResponseTime,
 CAST((event_id + copy) % 4 AS DOUBLE) AS Prediction, event_id
FROM events, (SELECT unnest([0, 1]) AS copy) WHERE event_type <> 'error' AND (copy = 0 OR event_id % 10 = 0)"""

_DERIVED = {
    "flights": _FLIGHTS_SQL, "airplanes": _AIRPLANES_SQL, "airlines": _AIRLINES_SQL, "requests": _REQUESTS_SQL,
    "responses": _RESPONSES_SQL,
    "distances": "SELECT Origin, Dest, avg(Distance) AS Distance FROM flights GROUP BY Origin, Dest",
    "features": """
SELECT *, CAST(FlightDate || ' ' || CASE WHEN left(CRSDepTime, 2) = '24' THEN '23:59'
   ELSE left(CRSDepTime, 2) || ':' || right(CRSDepTime, 2) END AS TIMESTAMP) AS dep,
 CAST(FlightDate || ' ' || CASE WHEN left(CRSArrTime, 2) = '24' THEN '23:59'
   ELSE left(CRSArrTime, 2) || ':' || right(CRSArrTime, 2) END AS TIMESTAMP) AS arr
FROM flights WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL""",
}

_FEATURES_SELECT = """
SELECT FlightNum, FlightDate, DayOfWeek, DayofMonth AS DayOfMonth, CAST(dayofyear(CAST(FlightDate AS DATE)) AS INT)
 AS DayOfYear, Carrier, Origin, Dest, Distance, DepDelay, ArrDelay,
 strftime(dep, '%Y-%m-%d %H:%M:%S') AS CRSDepTime,
 strftime(CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END, '%Y-%m-%d %H:%M:%S') AS CRSArrTime
FROM features"""

_ORDER = ["flights", "airplanes", "airlines", "requests", "responses", "distances", "features"]
_MICROS = "'%Y-%m-%dT%H:%M:%S.%f'"


def _md5_bucket(key: str, buckets: str) -> str:
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {buckets})"


def query(*uses: str, sql: str | None = None):
    """Register a query; ``uses`` names the derived tables its SQL text reads."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.prepare(spark), sf_dir.rstrip("/"))
        QUERIES[fn.__name__] = run
        if sql is not None:
            needed = set(uses)
            if needed & {"distances", "features"}:
                needed.add("flights")
            parts = [f"{name} AS ({_DERIVED[name]})" for name in _ORDER if name in needed]
            ORACLES[fn.__name__] = (f"WITH {', '.join(parts)} " if parts else "") + sql.strip()
        return fn
    return register


# --- shared inputs ----------------------------------------------------------------------------------------------------

_built: dict[tuple[str, str, str], object] = {}
_SOURCES = ("lineitem", "orders", "supplier", "customer", "part", "nation")  # what flights are made of


def _file_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and latest change of a table, from the listing of its folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Build a shared input once per application and state of the source tables: when one of them changes, it is built anew."""
    state = [_file_state(spark, f"{sf_dir}/{table}.parquet") for table in _SOURCES]
    key = (spark.sparkContext.applicationId, f"{sf_dir} {state}", name)
    if key not in _built:
        _built[key] = make()
    return _built[key]


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide on-time-performance table, written once to the shared folder; later queries scan what they need.

    Rows of a date lie together and sorted, so lookups by date skip most row groups.
    """
    def make() -> str:
        path = session.work_folder(spark, "on_time_performance")
        fixtures.with_page_columns(fixtures.flights_by_date(spark, sf_dir)).write.parquet(path)
        return path
    return spark.read.parquet(_once(spark, sf_dir, "flights", make))


def _distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> str:
        path = session.work_folder(spark, "origin_dest_distances")
        routes = fixtures.flights(spark, sf_dir, ("Origin", "Dest", "Distance"))
        aggregates.mean_distance(routes).write.parquet(path)
        return path
    return spark.read.parquet(_once(spark, sf_dir, "distances", make))


def _trained(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the trained chain and its confusion counts, made once."""
    def make() -> str:
        path = session.work_folder(spark, "model")
        trained = training.train(features.extract(_flights(spark, sf_dir)))
        training.save(trained.model, path)
        trained.confusion.write.parquet(f"{path}/confusion")
        return path
    return _once(spark, sf_dir, "model", make)


def _model(spark: SparkSession, sf_dir: str):
    """The trained chain, loaded from its files."""
    return training.load(spark, _trained(spark, sf_dir))


def build(spark: SparkSession, sf_dir: str) -> None:
    """Make the shared inputs: the wide table, the distances and the trained chain."""
    session.prepare(spark)
    _flights(spark, sf_dir)
    _distances(spark, sf_dir)
    _trained(spark, sf_dir)


def _typed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with distance and date parts, as stored by the request jobs; the timestamp stays a timestamp."""
    made = requests.build(fixtures.requests(spark, sf_dir).withColumnRenamed("Timestamp", "_at"),
                          _distances(spark, sf_dir), as_of=F.col("_at"))
    return made.withColumns({"Timestamp": F.col("_at"), "FlightDate": F.col("FlightDate").cast("date")}).drop("_at")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, one file or a directory of part files, as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return readers.message_stream(spark, "parquet", {}, schema, f"{sf_dir}/events[.]parquet")


def _plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    shown = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DateType):
            shown[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(shown) if shown else df


def _numbered(page: DataFrame, *order) -> DataFrame:
    """A page of a few rows with the position that each has in it, counted from 1 in the order the rows come."""
    return page.withColumn("position", F.row_number().over(W.orderBy(*order)))


# --- flights and features ---------------------------------------------------------------------------------------------

@query("flights", sql="SELECT * FROM flights")
def flights_view(spark, sf_dir):
    return fixtures.flights(spark, sf_dir)


@query("distances", sql="SELECT Origin, Dest, Distance FROM distances")
def distance_avg(spark, sf_dir):
    return features.distances(fixtures.flights(spark, sf_dir, ("Origin", "Dest", "Distance")))


@query("distances", sql="SELECT DISTINCT Origin, Dest, Distance FROM distances")
def distance_desc_distinct(spark, sf_dir):
    return features.distances(_flights(spark, sf_dir), descending=True).distinct()


@query("features", sql=_FEATURES_SELECT)
def features_extracted(spark, sf_dir):
    return _plain(features.extract(_flights(spark, sf_dir)).orderBy(*ordering.FEATURE_ORDER))


@query("features", sql=f"{_FEATURES_SELECT} WHERE {_md5_bucket('row_key', '10')} = 0")
def features_hash_sample(spark, sf_dir):
    sampled = ordering.hash_sample(_flights(spark, sf_dir), F.col("row_key"), 10)
    return _plain(features.extract(sampled))


@query("features", sql=f"""
SELECT row_key, strftime(dep, '%Y-%m-%d %H:%M:%S') AS CRSDepTime, Carrier, Origin, Dest, DepDelay, ArrDelay
FROM features WHERE {_md5_bucket("'18:' || row_key", '1000')} = 0 ORDER BY dep, row_key LIMIT 6""")
def sample_top6(spark, sf_dir):
    known = _flights(spark, sf_dir).where("ArrDelay IS NOT NULL AND DepDelay IS NOT NULL")
    sampled = ordering.hash_sample(known, F.col("row_key"), 1000, seed="18")
    timed = sampled.withColumn("CRSDepTime", times.scheduled_at(F.col("FlightDate"), F.col("CRSDepTime")))
    top = ordering.top_by(timed, ["CRSDepTime", "row_key"], 6)
    return _plain(top.select("row_key", "CRSDepTime", "Carrier", "Origin", "Dest", "DepDelay", "ArrDelay"))


_PROFILED = ["ArrDelay", "CRSArrTime", "CRSDepTime", "Carrier", "DayofMonth", "DayOfWeek", "DepDelay", "Dest",
             "Distance", "FlightDate", "FlightNum", "Origin", "WeatherDelay"]


@query("flights", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS null_count FROM flights"
    for name in _PROFILED) + ") WHERE null_count > 0")
def null_profile(spark, sf_dir):
    return aggregates.null_profile(_flights(spark, sf_dir), _PROFILED)


@query("flights", sql="""
SELECT row_key, ArrDelay, CAST(CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1 WHEN ArrDelay < 30 THEN 2
 WHEN ArrDelay IS NOT NULL THEN 3 END AS DOUBLE) AS ArrDelayBucket FROM flights""")
def delay_bucket(spark, sf_dir):
    return training.delay_bucketizer().transform(_flights(spark, sf_dir).select("row_key", "ArrDelay"))


@query("flights", sql="""
SELECT CAST(CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1 WHEN ArrDelay < 30 THEN 2
 WHEN ArrDelay IS NOT NULL THEN 3 END AS DOUBLE) AS ArrDelayBucket, count(*) AS "count" FROM flights GROUP BY 1""")
def bucket_distribution(spark, sf_dir):
    bucket = aggregates.bucket_delay(F.col("ArrDelay")).alias("ArrDelayBucket")
    return aggregates.distribution(_flights(spark, sf_dir).select(bucket), "ArrDelayBucket")


@query("flights", sql="""
SELECT row_key, concat("Month", '-', DayofMonth) AS month_day, CASE WHEN left(CRSDepTime, 2) = '24' THEN '23:59:00'
  ELSE left(CRSDepTime, 2) || ':' || right(CRSDepTime, 2) || ':00' END AS dep_clock,
 CASE WHEN left(CRSArrTime, 2) = '24' THEN '23:59:00'
  ELSE left(CRSArrTime, 2) || ':' || right(CRSArrTime, 2) || ':00' END AS arr_clock,
 CASE WHEN left(CRSArrTime, 2) = '24' OR CRSArrTime >= CRSDepTime THEN FlightDate
  ELSE CAST(CAST(FlightDate AS DATE) + 1 AS VARCHAR) END AS arrival_date,
 CAST(isodow(CAST(FlightDate AS DATE)) - 1 AS INT) AS weekday0 FROM flights""")
def schedule_times(spark, sf_dir):
    departure = times.scheduled_at(F.col("FlightDate"), F.col("CRSDepTime"))
    arrival = times.scheduled_at(F.col("FlightDate"), F.col("CRSArrTime"))
    return _flights(spark, sf_dir).select(
        "row_key",
        times.month_day(F.col("Month"), F.col("DayofMonth")).alias("month_day"),
        times.clock_text(F.col("CRSDepTime")).alias("dep_clock"),
        times.clock_text(F.col("CRSArrTime")).alias("arr_clock"),
        times.next_day_if_before(arrival, departure).cast("date").cast("string").alias("arrival_date"),
        times.day_of_week(times.iso_day(F.col("FlightDate")), "weekday0").alias("weekday0"),
    )


def _index_of(spark, sf_dir, column):
    rows = training.with_route(_flights(spark, sf_dir).select("Carrier", "Origin", "Dest"))
    return training.label_index(rows, [column]).select(
        F.col("label").alias(column), "rows", F.col("index").alias(training.index_name(column)))


@query("flights", sql="""
SELECT Carrier, n AS "rows", CAST(row_number() OVER (ORDER BY n DESC, Carrier) - 1 AS DOUBLE) AS Carrier_index
FROM (SELECT Carrier, count(*) AS n FROM flights GROUP BY Carrier)""")
def carrier_index(spark, sf_dir):
    return _index_of(spark, sf_dir, "Carrier")


@query("flights", sql="""
SELECT Route, n AS "rows", CAST(row_number() OVER (ORDER BY n DESC, Route) - 1 AS DOUBLE) AS Route_index
FROM (SELECT Origin || '-' || Dest AS Route, count(*) AS n FROM flights GROUP BY 1)""")
def route_index(spark, sf_dir):
    return _index_of(spark, sf_dir, "Route")


# --- requests ---------------------------------------------------------------------------------------------------------

def _request_sql(delay: str, week: str, distance: str) -> str:
    return f"""
SELECT r.UUID AS request, CASE WHEN event_id % 50 = 0 THEN NULL ELSE {delay} END AS DepDelay, Carrier, FlightDate,
 r.Dest, FlightNum, r.Origin, {distance} AS Distance, CAST(dayofyear(CAST(FlightDate AS DATE)) AS INT) AS DayOfYear,
 CAST(day(CAST(FlightDate AS DATE)) AS INT) AS DayOfMonth, CAST({week} AS INT) AS DayOfWeek,
 strftime("Timestamp", {_MICROS}) AS "Timestamp", sha256('{{"request":"' || r.UUID || '"}}') AS UUID
FROM requests r LEFT JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest"""


_ISO_WEEK = "isodow(CAST(FlightDate AS DATE))"


def _forms(requests_: DataFrame) -> DataFrame:
    """Form rows with their own request name and the instant they arrived."""
    return fixtures.raw_forms(requests_).withColumnsRenamed({"UUID": "request", "Timestamp": "_at"})


def _enriched(spark, sf_dir, **options):
    raw = _forms(fixtures.requests(spark, sf_dir))
    return requests.realtime_requests(raw, _distances(spark, sf_dir), forms.replayable_id(F.col("request")),
                                      as_of=F.col("_at"), **options).drop("_at")


@query("requests", "distances", sql=_request_sql("DepDelay", _ISO_WEEK, "coalesce(d.Distance, 0)"))
def request_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query("requests", "distances", sql=_request_sql(
    "DepDelay", f"{_ISO_WEEK} - 1", "coalesce(CAST(trunc(d.Distance) AS INT), 0)"))
def request_enriched_weekday0(spark, sf_dir):
    return _enriched(spark, sf_dir, numbering="weekday0", integer_distance=True)


@query("requests", "distances", sql=_request_sql("trunc(DepDelay)", _ISO_WEEK, "coalesce(d.Distance, 0)"))
def request_regression(spark, sf_dir):
    rounded = fixtures.requests(spark, sf_dir).withColumn("DepDelay", F.col("DepDelay").cast("int"))
    raw = _forms(rounded)
    made = requests.regression_requests(raw, _distances(spark, sf_dir), as_of=F.col("_at"),
                                        request_id=forms.replayable_id(F.col("request"))).drop("_at")
    return made.withColumn("DepDelay", F.col("DepDelay").cast("double"))


@query("requests", "distances", sql="""
SELECT r.UUID, r.Origin, r.Dest FROM requests r
WHERE NOT EXISTS (SELECT 1 FROM distances d WHERE r.Origin = d.Origin AND r.Dest = d.Dest)""")
def unknown_routes(spark, sf_dir):
    return joins.unknown_routes(fixtures.requests(spark, sf_dir), _distances(spark, sf_dir)).select(
        "UUID", "Origin", "Dest")


@query("requests", "distances", sql="""
SELECT r.UUID, r.Origin, r.Dest, d.Distance FROM requests r JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest""")
def known_route_requests(spark, sf_dir):
    return joins.with_distance(fixtures.requests(spark, sf_dir), _distances(spark, sf_dir), missing="drop").select(
        "UUID", "Origin", "Dest", "Distance")


# --- lookups and search -----------------------------------------------------------------------------------------------

_LOOKUP = {"Carrier": "Brand#7", "FlightDate": "1998-05-05"}


@query("flights", sql="""
SELECT Carrier, FlightDate, FlightNum, Origin, Dest, TailNum, Distance / 8 AS AirTime, Distance, row_key FROM flights
WHERE Carrier = 'Brand#7' AND FlightDate = '1998-05-05' AND FlightNum = (SELECT min(FlightNum) FROM flights
 WHERE Carrier = 'Brand#7' AND FlightDate = '1998-05-05') ORDER BY row_key LIMIT 1""")
def flight_lookup(spark, sf_dir):
    flights = _flights(spark, sf_dir)
    number = flights.where(lookups.equals_all(**_LOOKUP)).agg(F.min("FlightNum")).scalar()
    found = lookups.find_one(flights, ["row_key"], **_LOOKUP, FlightNum=number)
    return found.select("Carrier", "FlightDate", "FlightNum", "Origin", "Dest", "TailNum", "AirTime", "Distance",
                        "row_key")


@query("flights", sql="""
SELECT Carrier, FlightDate, FlightNum, row_key, Origin, Dest, TailNum FROM (SELECT *, row_number() OVER (
 PARTITION BY Carrier, FlightDate, FlightNum ORDER BY row_key) AS rn FROM flights) WHERE rn = 1""")
def flight_lookup_all(spark, sf_dir):
    rows = _flights(spark, sf_dir).select("Carrier", "FlightDate", "FlightNum", "row_key", "Origin", "Dest", "TailNum")
    return lookups.first_per_key(rows, ["Carrier", "FlightDate", "FlightNum"], ["row_key"])


@query("flights", sql="""
SELECT Carrier, FlightNum, Origin, Dest, CRSDepTime AS DepTime, TailNum, Distance / 8 AS AirTime, Distance, row_key,
 count(*) OVER () AS flight_count,
 CAST(row_number() OVER (ORDER BY CRSDepTime NULLS FIRST, CRSArrTime NULLS FIRST, row_key) AS INT) AS position FROM flights
WHERE (Origin, Dest, FlightDate) = (SELECT (Origin, Dest, FlightDate) FROM flights GROUP BY Origin, Dest, FlightDate
 ORDER BY count(*) DESC, Origin, Dest, FlightDate LIMIT 1)""")
def route_day_flights(spark, sf_dir):
    """The busiest route and day, in the order of the page."""
    flights = _flights(spark, sf_dir)
    busiest = flights.groupBy("Origin", "Dest", "FlightDate").count().orderBy(
        F.col("count").desc(), "Origin", "Dest", "FlightDate").first()
    page = lookups.route_day(flights, busiest.Origin, busiest.Dest, busiest.FlightDate, ["row_key"])
    return _numbered(page, "DepTime", "ArrTime", "row_key").select(
        "Carrier", "FlightNum", "Origin", "Dest", "DepTime", "TailNum", "AirTime", "Distance", "row_key", "flight_count", "position")


@query("flights", sql="""
SELECT Origin, Dest, FlightDate, count(*) AS flight_count, min(CRSDepTime) AS first_departure FROM flights
GROUP BY Origin, Dest, FlightDate""")
def route_day_board(spark, sf_dir):
    return _flights(spark, sf_dir).groupBy("Origin", "Dest", "FlightDate").agg(
        F.count(F.lit(1)).alias("flight_count"), F.min("DepTime").alias("first_departure"))


_FLIGHT_PAGE_SQL = """
SELECT Carrier, FlightNum, Origin, Dest, FlightDate, CRSDepTime AS DepTime, TailNum, Distance / 8 AS AirTime, Distance,
 row_key, count(*) OVER () AS flight_count,
 CAST(row_number() OVER (ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key) - {start} AS INT) AS position
FROM flights WHERE {where} ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key LIMIT 10 OFFSET {start}"""
_PAGE_COLUMNS = ["Carrier", "FlightNum", "Origin", "Dest", "FlightDate", "DepTime", "TailNum", "AirTime", "Distance",
                 "row_key"]


def _shown_page(page: DataFrame) -> DataFrame:
    return _numbered(page, "FlightDate", "DepTime", "Carrier", "FlightNum", "row_key").select(*_PAGE_COLUMNS, "flight_count", "position")


@query("flights", sql=_FLIGHT_PAGE_SQL.format(where="Carrier = 'Brand#7'", start=20))
def flight_search_page(spark, sf_dir):
    return _shown_page(search.flight_search(
        _flights(spark, sf_dir), {"Carrier": "Brand#7", "Dest": ""}, schemas.FLIGHT_SEARCH_FIELDS, ties=("row_key",), start=20))


@query("flights", sql=_FLIGHT_PAGE_SQL.format(
    where="list_has_any(regexp_split_to_array(lower(Carrier), '[^a-z0-9_]+'), ['7', '9']) AND lower(Dest) = 'nation_4'",
    start=0))
def flight_search_match(spark, sf_dir):
    return _shown_page(search.flight_search(
        _flights(spark, sf_dir), {"Carrier": "7 9", "Dest": "Nation_4"}, schemas.FLIGHT_SEARCH_FIELDS,
        ties=("row_key",), words=("Carrier", "Dest")))


@query("flights", sql=_FLIGHT_PAGE_SQL.format(where="true", start=0))
def flight_search_all(spark, sf_dir):
    return _shown_page(search.flight_search(_flights(spark, sf_dir), {}, schemas.FLIGHT_SEARCH_FIELDS, ties=("row_key",)))


@query("flights", sql="""
SELECT Carrier, FlightNum, Origin, Dest, FlightDate, CRSDepTime AS DepTime, TailNum, Distance / 8 AS AirTime, Distance,
 row_key FROM flights WHERE Origin = 'NATION_3' AND (FlightDate, CRSDepTime, Carrier, FlightNum, row_key)
 > ('1998-05-05', '1200', 'Brand#7', '2000', '0')
ORDER BY FlightDate, CRSDepTime, Carrier, FlightNum, row_key LIMIT 10""")
def flight_page_after(spark, sf_dir):
    return search.page_after(
        _flights(spark, sf_dir), F.col("Origin") == "NATION_3", (*search.FLIGHT_ORDER, "row_key"),
        ("1998-05-05", "1200", "Brand#7", "2000", "0")).select(*_PAGE_COLUMNS)


@query("airplanes", sql="""
SELECT *, count(*) OVER () AS airplane_count, CAST(row_number() OVER (ORDER BY Owner, TailNum) - 10 AS INT) AS position FROM airplanes
WHERE list_has_any(regexp_split_to_array(lower(Manufacturer), '[^a-z0-9_]+'), ['brand']) AND lower(Model) = 'economy'
ORDER BY Owner, TailNum LIMIT 10 OFFSET 10""")
def airplane_search_page(spark, sf_dir):
    return _numbered(search.airplane_search(
        fixtures.airplanes(spark, sf_dir), {"Manufacturer": "brand", "Model": "economy", "Owner": None},
        schemas.AIRPLANE_SEARCH_FIELDS, ties=("TailNum",), words=("Manufacturer", "Model"), start=10), "Owner", "TailNum")


@query("flights", sql="""
SELECT TailNum, count(*) OVER () AS FlightCount, Carrier, FlightDate, FlightNum, Origin, Dest
FROM flights WHERE TailNum = 'Supplier#000000003'""")
def tail_lookup(spark, sf_dir):
    return documents.flights_per_airplane(_flights(spark, sf_dir).where(lookups.equals_all(TailNum="Supplier#000000003")))


@query("airlines", sql="SELECT * FROM airlines WHERE CarrierCode = 'Brand#7'")
def carrier_lookup(spark, sf_dir):
    return lookups.find_one(fixtures.airlines(spark, sf_dir), ["Name"], CarrierCode="Brand#7")


# --- summaries and documents ------------------------------------------------------------------------------------------

@query("flights", sql='SELECT "Year", "Month", count(*) AS total_flights FROM flights GROUP BY 1, 2')
def flights_by_month(spark, sf_dir):
    return aggregates.flights_by_month(_flights(spark, sf_dir)).orderBy("Year", "Month")


@query("airplanes", sql="SELECT Manufacturer, count(*) AS Total FROM airplanes GROUP BY 1")
def manufacturer_totals(spark, sf_dir):
    return aggregates.manufacturer_totals(fixtures.airplanes(spark, sf_dir))


@query("airplanes", sql="""
SELECT Manufacturer, Total FROM (SELECT Manufacturer, count(*) AS Total FROM airplanes GROUP BY 1) ORDER BY Total DESC, Manufacturer""")
def manufacturer_chart(spark, sf_dir):
    totals = aggregates.manufacturer_totals(fixtures.airplanes(spark, sf_dir))
    return documents.chart(totals, "Manufacturer", "Total")


@query("flights", sql="""
SELECT CAST(least(floor((WeatherDelay - lo) * 10 / (hi - lo)), 9) AS INT) AS label, count(*) AS value
FROM flights, (SELECT min(WeatherDelay) AS lo, max(WeatherDelay) AS hi FROM flights)
WHERE WeatherDelay IS NOT NULL GROUP BY 1""")
def weather_histogram(spark, sf_dir):
    return aggregates.histogram(_flights(spark, sf_dir), "WeatherDelay", 10)


@query("flights", sql="""
SELECT * FROM (WITH v AS (SELECT CASE WHEN DayofMonth = 1 THEN 'NaN'::DOUBLE WHEN DayofMonth = 2 THEN 'Infinity'::DOUBLE
  WHEN DayofMonth = 3 THEN '-Infinity'::DOUBLE ELSE WeatherDelay END AS x FROM flights WHERE WeatherDelay IS NOT NULL),
 b AS (SELECT min(x) AS lo, max(x) AS hi FROM v WHERE isfinite(x))
SELECT CASE WHEN isfinite(x) THEN CAST(least(floor((x - lo) * 10 / (hi - lo)), 9) AS INT) ELSE -1 END AS label, count(*) AS value
FROM v, b GROUP BY 1)""")
def weather_histogram_nonfinite(spark, sf_dir):
    """NaN and infinite values are counted apart and leave the buckets as they are."""
    day, inf = F.col("DayofMonth"), float("inf")
    odd = F.when(day == 1, float("nan")).when(day == 2, inf).when(day == 3, -inf).otherwise(F.col("WeatherDelay"))
    known = _flights(spark, sf_dir).where("WeatherDelay IS NOT NULL")
    return aggregates.histogram(known.select(odd.alias("x")), "x", 10)


@query("flights", sql="""
SELECT CASE WHEN WeatherDelay < 10 THEN 0 WHEN WeatherDelay < 25 THEN 1 ELSE 2 END AS label, count(*) AS value
FROM flights WHERE WeatherDelay BETWEEN 0 AND 40 GROUP BY 1""")
def weather_histogram_edges(spark, sf_dir):
    return aggregates.histogram_by_edges(_flights(spark, sf_dir), "WeatherDelay", [0.0, 10.0, 25.0, 40.0])


@query("flights", sql="""
SELECT max(total_flights) AS max_value FROM (SELECT count(*) AS total_flights FROM flights GROUP BY "Year", "Month")""")
def chart_max(spark, sf_dir):
    return aggregates.maximum(aggregates.flights_by_month(_flights(spark, sf_dir)), "total_flights")


@query("flights", sql="""
SELECT TailNum, count(*) OVER (PARTITION BY TailNum) AS FlightCount, Carrier, FlightDate, FlightNum, Origin, Dest FROM flights""")
def flights_per_airplane(spark, sf_dir):
    return documents.flights_per_airplane(_flights(spark, sf_dir))


_FLEET_COUNT_SQL = "(SELECT Carrier, count(DISTINCT TailNum) AS FleetCount FROM {table} GROUP BY Carrier)"


@query("flights", sql=f"""
SELECT Carrier, FleetCount, TailNum FROM {_FLEET_COUNT_SQL.format(table='flights')} LEFT JOIN
 (SELECT DISTINCT Carrier, TailNum FROM flights WHERE TailNum IS NOT NULL) USING (Carrier)""")
def fleet_per_carrier(spark, sf_dir):
    return documents.fleet_per_carrier(_flights(spark, sf_dir))


@query("flights", sql=f"""
SELECT * FROM (WITH partly AS (SELECT Carrier, CASE WHEN Carrier IN ('Brand#7', 'Brand#9') THEN NULL ELSE TailNum END AS TailNum FROM flights)
SELECT Carrier, FleetCount, TailNum FROM {_FLEET_COUNT_SQL.format(table='partly')} LEFT JOIN
 (SELECT DISTINCT Carrier, TailNum FROM partly WHERE TailNum IS NOT NULL) USING (Carrier))""")
def fleet_pages(spark, sf_dir):
    """Carriers whose tail numbers are all unknown keep their row."""
    unknown = F.when(~F.col("Carrier").isin("Brand#7", "Brand#9"), F.col("TailNum"))
    return documents.fleet_per_carrier(_flights(spark, sf_dir).withColumn("TailNum", unknown))


@query("flights", sql="SELECT DISTINCT Carrier FROM flights")
def carrier_list(spark, sf_dir):
    return documents.carriers(_flights(spark, sf_dir))


@query("flights", "airlines", sql=f"""
SELECT a.*, f.Carrier, CAST(f.FleetCount AS DOUBLE) AS FleetCount, coalesce(a.CarrierCode, f.Carrier) AS carrier_code
FROM airlines a FULL JOIN {_FLEET_COUNT_SQL.format(table='flights')} f ON a.CarrierCode = f.Carrier""")
def airline_page(spark, sf_dir):
    counts = documents.fleet_counts(_flights(spark, sf_dir))
    page = joins.airline_page(fixtures.airlines(spark, sf_dir), counts)
    return page.withColumn("FleetCount", F.col("FleetCount").cast("double"))


# --- requests and responses -------------------------------------------------------------------------------------------

def _response_rows(events: DataFrame) -> DataFrame:
    """Responses to all requests but those of error events; every tenth is answered twice."""
    copies = F.explode(F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    answered = events.where("event_type <> 'error'").withColumn("copy", copies)
    return answered.select(
        F.col("event_id").cast("string").alias("UUID"), "copy",
        F.expr("CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, event_id % 900 + copy)").alias("ResponseTime"),
        F.expr("CAST((event_id + copy) % 4 AS DOUBLE)").alias("Prediction"), "event_id", "user_id", "value")


def _responses(spark, sf_dir):
    return _response_rows(fixtures.table(spark, sf_dir, "events"))


@query("requests", "responses", sql="""
SELECT r.UUID, r.Carrier, p.Prediction, CASE WHEN p.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status
FROM requests r LEFT JOIN (SELECT * FROM responses x WHERE NOT EXISTS (SELECT 1 FROM responses y
 WHERE y.UUID = x.UUID AND y.ResponseTime > x.ResponseTime)) p ON r.UUID = p.UUID""")
def response_status(spark, sf_dir):
    asked = fixtures.requests(spark, sf_dir).select("UUID", "Carrier")
    return joins.request_status(asked, _responses(spark, sf_dir), ["ResponseTime"])


def _response_messages(rows: DataFrame) -> DataFrame:
    """Responses with all fields of the response table."""
    return rows.select(
        "UUID", F.expr("concat('NATION_', CAST(event_id % 25 AS STRING))").alias("Origin"),
        F.expr("concat('NATION_', CAST(user_id % 25 AS STRING))").alias("Dest"),
        F.expr("concat('Brand#', CAST(event_id % 26 AS STRING))").alias("Carrier"), F.col("value").alias("DepDelay"),
        "Prediction", times.iso_text(F.col("ResponseTime")).alias("Timestamp"),
        F.col("ResponseTime").cast("date").cast("string").alias("FlightDate"),
        (F.weekday("ResponseTime") + 1).alias("DayOfWeek"), F.dayofyear("ResponseTime").alias("DayOfYear"),
        F.dayofmonth("ResponseTime").alias("DayOfMonth"), F.lit(100.0).alias("Distance"),
        F.expr("concat('NATION_', CAST(event_id % 25 AS STRING), '-NATION_', CAST(user_id % 25 AS STRING))")
        .alias("Route"))


_LATEST_SQL = f"""
SELECT UUID AS uuid, concat('NATION_', event_id % 25) AS origin, concat('NATION_', user_id % 25) AS dest,
 concat('Brand#', event_id % 26) AS carrier, value AS depdelay, Prediction AS prediction,
 strftime(ResponseTime, {_MICROS}) AS "timestamp", CAST(CAST(ResponseTime AS DATE) AS VARCHAR) AS flightdate,
 CAST(isodow(ResponseTime) AS INT) AS dayofweek, CAST(dayofyear(ResponseTime) AS INT) AS dayofyear,
 CAST(day(ResponseTime) AS INT) AS dayofmonth, CAST(100 AS DOUBLE) AS distance,
 concat('NATION_', event_id % 25, '-NATION_', user_id % 25) AS route
FROM (SELECT r.*, e.user_id, e.value, row_number() OVER (PARTITION BY UUID ORDER BY copy DESC) AS rn
 FROM responses r JOIN events e USING (event_id)) WHERE rn = 1"""


def _upserted(spark, sf_dir) -> DataFrame:
    """First answers by one writer, second ones by another, and both batches sent again, the older one last, as after a restart.

    All writers start with batch 0. Answers carry their own time, so the later answer wins whenever it was written.
    """
    path = session.work_folder(spark, "responses")
    rows = _responses(spark, sf_dir)
    sent = lambda copy: keyed.response_rows(_response_messages(rows.where(F.col("copy") == copy)))
    keyed.append(sent(0), path, "first", 0)
    keyed.append(sent(1), path, "second", 0)
    keyed.append(sent(1), path, "second", 0)
    keyed.append(sent(0), path, "first", 0)
    return keyed.responses(spark, path)


@query("responses", sql=_LATEST_SQL)
def latest_response_upsert(spark, sf_dir):
    return _upserted(spark, sf_dir)


@query("responses", sql=_LATEST_SQL)
def responses_compacted(spark, sf_dir):
    """Several writes folded into one place, the older answers written again afterwards and folded once more."""
    path = session.work_folder(spark, "responses")
    rows = _responses(spark, sf_dir)
    old, new = (keyed.response_rows(_response_messages(rows.where(F.col("copy") == copy))) for copy in (0, 1))
    for batch, sent in enumerate((old, new, old)):
        keyed.append(sent, path, "first", batch)
    keyed.compact(spark, path, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
    keyed.append(old, path, "first", 1)
    keyed.compact(spark, path, keyed.RESPONSE_KEY, keyed.RESPONSE_ORDER)
    return spark.read.parquet(path).drop("writer", "batch")


@query("responses", sql=f"SELECT uuid, prediction FROM ({_LATEST_SQL}) WHERE uuid = '40'")
def response_lookup(spark, sf_dir):
    return lookups.find_one(_upserted(spark, sf_dir), ["uuid"], uuid="40").select("uuid", "prediction")


@query("distances", sql="""
SELECT Origin AS origin, Dest AS dest, CAST(trunc(Distance) AS INT) + CASE WHEN Origin < 'NATION_2' THEN 1 ELSE 0 END AS distance
FROM distances""")
def distance_int_table(spark, sf_dir):
    """Two different imports: the second changes some routes and leaves out all others, which stay."""
    table = keyed.merged_distances(None, _distances(spark, sf_dir))
    some = _distances(spark, sf_dir).where("Origin < 'NATION_2'").withColumn("Distance", F.col("Distance") + 1)
    return keyed.merged_distances(table, some)


_DAY = "2024-01-15"
_REQUEST_COLUMNS = ["UUID", "Carrier", "Origin", "Dest", "FlightNum", "FlightDate", "DepDelay"]


@query("requests", sql=f"""
SELECT UUID, Carrier, Origin, Dest, FlightNum, FlightDate, DepDelay FROM requests
WHERE "Timestamp" >= DATE '{_DAY}' AND "Timestamp" < DATE '{_DAY}' + 1""")
def daily_requests(spark, sf_dir):
    return fixtures.requests(spark, sf_dir).where(daily.of_day("Timestamp", _DAY)).select(*_REQUEST_COLUMNS)


@query("requests", sql=f"""
SELECT UUID, Carrier, Origin, Dest, FlightNum, FlightDate, DepDelay FROM requests
WHERE strftime("Timestamp", {_MICROS}) >= '{_DAY}' AND strftime("Timestamp", {_MICROS}) <= '2024-01-16'""")
def daily_requests_lexical(spark, sf_dir):
    tasks = fixtures.requests(spark, sf_dir).withColumn("Timestamp", times.iso_text(F.col("Timestamp")))
    return tasks.where(daily.of_day("Timestamp", _DAY, lexical=True)).select(*_REQUEST_COLUMNS)


def _ruled(rows: DataFrame) -> DataFrame:
    """A fixed rule in place of a model: the class follows from the departure delay."""
    return rows.withColumn("Prediction", aggregates.bucket_delay(F.col("DepDelay") - 60))


_RULE_SQL = "CASE WHEN DepDelay < 45 THEN 0 WHEN DepDelay < 60 THEN 1 WHEN DepDelay < 90 THEN 2 ELSE 3 END"
_MESSAGES_SQL = """WHEN 0 THEN 'Early (15+ Minutes Early)' WHEN 1 THEN 'Slightly Early (0-15 Minute Early)'
 WHEN 2 THEN 'Slightly Late (0-30 Minute Delay)' WHEN 3 THEN 'Very Late (30+ Minutes Late)'"""
_MESSAGES_3_SQL = """WHEN 0 THEN 'On Time (0-15 Minute Delay)' WHEN 1 THEN 'Slightly Late (15-60 Minute Delay)'
 WHEN 2 THEN 'Very Late (60+ Minute Delay)'"""


@query("requests", "distances", sql=f"""
SELECT strftime("Timestamp", '%Y-%m-%d %H:%M:%S') AS "Timestamp", Carrier, FlightDate, r.Origin, r.Dest,
 coalesce(Distance, 0) AS Distance, DepDelay, CASE {_RULE_SQL} {_MESSAGES_SQL} END AS Predicted
FROM requests r LEFT JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest
WHERE "Timestamp" >= DATE '{_DAY}' AND "Timestamp" < DATE '{_DAY}' + 1""")
def batch_results(spark, sf_dir):
    return _plain(daily.results_page(_ruled(_typed_requests(spark, sf_dir)), _DAY))


@query("requests", sql=f"SELECT UUID, CASE {_RULE_SQL} {_MESSAGES_SQL} END AS message FROM requests")
def class_label_4(spark, sf_dir):
    ruled = _ruled(fixtures.requests(spark, sf_dir))
    return ruled.select("UUID", text.class_label(F.col("Prediction")).alias("message"))


@query("requests", sql=f"SELECT UUID, CASE {_RULE_SQL} {_MESSAGES_3_SQL} END AS message FROM requests")
def class_label_3(spark, sf_dir):
    ruled = _ruled(fixtures.requests(spark, sf_dir))
    return ruled.select("UUID", text.class_label(F.col("Prediction"), text.DELAY_CLASSES_3).alias("message"))


# --- messages ---------------------------------------------------------------------------------------------------------

def _messages(events: DataFrame) -> DataFrame:
    """Request messages of all events; some are cut off in the middle and some carry no id."""
    rows = fixtures.request_rows(events)
    number = F.col("UUID").cast("bigint")
    body = messages.render(
        F.when(number % 43 != 0, F.col("UUID")).alias("UUID"), times.iso_text(F.col("Timestamp")).alias("Timestamp"),
        "Carrier", "Origin", "Dest", "FlightNum", "FlightDate", "DepDelay",
        F.when(number % 7 != 0, F.lit(250.5)).alias("Distance"))
    return rows.select(F.when(number % 41 == 0, F.substring(body, 1, 30)).otherwise(body).cast("binary").alias("value"))


_PARSED_SQL = f"""
SELECT Origin, CAST(NULL AS INT) AS DayOfWeek, CAST(NULL AS INT) AS DayOfYear, CAST(NULL AS INT) AS DayOfMonth, Dest,
 DepDelay, strftime("Timestamp", {_MICROS}) AS "Timestamp", FlightDate, Carrier, UUID,
 CASE WHEN event_id % 7 <> 0 THEN CAST(250.5 AS DOUBLE) END AS Distance
FROM requests WHERE event_id % 41 <> 0 AND event_id % 43 <> 0"""


def _shown_requests(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"Timestamp": times.iso_text(F.col("Timestamp")),
                             "FlightDate": F.col("FlightDate").cast("string")})


@query("requests", sql=_PARSED_SQL)
def json_parsed(spark, sf_dir):
    parsed = stream_messages.parsed(_messages(fixtures.table(spark, sf_dir, "events")))
    return _shown_requests(stream_messages.requests(parsed))


_VALUE_SQL = f"""concat('{{', CASE WHEN event_id % 43 <> 0 THEN '"UUID":"' || UUID || '",' ELSE '' END,
 '"Timestamp":"', strftime("Timestamp", {_MICROS}), '","Carrier":"', Carrier, '","Origin":"', Origin, '","Dest":"', Dest,
 '","FlightNum":"', FlightNum, '","FlightDate":"', FlightDate, '","DepDelay":', CAST(DepDelay AS VARCHAR),
 CASE WHEN event_id % 7 <> 0 THEN ',"Distance":250.5' ELSE '' END, '}}')"""


@query("requests", sql=f"""
SELECT CASE WHEN event_id % 41 = 0 THEN substr({_VALUE_SQL}, 1, 30) ELSE {_VALUE_SQL} END AS value
FROM requests WHERE event_id % 41 = 0 OR event_id % 43 = 0""")
def json_rejects(spark, sf_dir):
    return stream_messages.rejects(stream_messages.parsed(_messages(fixtures.table(spark, sf_dir, "events"))))


@query("requests", sql=f"""
SELECT concat('{{"UUID":"', UUID, '","Timestamp":"', strftime("Timestamp", '%Y-%m-%dT%H:%M:%S.%g'), 'Z","DepDelay":',
 CASE WHEN event_id % 2 = 0 THEN CAST(DepDelay AS VARCHAR) || ',"even":true' ELSE CAST(DepDelay AS VARCHAR) END, '}}')
 AS value FROM requests""")
def json_out(spark, sf_dir):
    rows = fixtures.requests(spark, sf_dir)
    even = F.when(F.col("UUID").cast("bigint") % 2 == 0, F.lit(True)).alias("even")
    return writers.as_messages(rows.select("UUID", "Timestamp", "DepDelay", even))


@query(sql="""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def props_parsed(spark, sf_dir):
    props = messages.parse(F.col("props"), schemas.layout(k="int"))
    return fixtures.table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


@query(sql="""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '?start=' || page_id ELSE url END AS url FROM pages""")
def url_stripped(spark, sf_dir):
    number = F.col("page_id").cast("string")
    paging = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("?start="), number)).when(
        F.col("page_id") % 3 == 1, F.concat(F.lit("?start="), number, F.lit("&end="), number)).otherwise(F.lit(""))
    return fixtures.table(spark, sf_dir, "pages").select(
        "page_id", text.strip_paging(F.concat("url", paging)).alias("url"))


@query(sql="""
SELECT DISTINCT p_name || ' ' || p_type AS name, CASE WHEN length(p_name || ' ' || p_type) > 14
 THEN substr(p_name || ' ' || p_type, 1, 14) || '...' ELSE p_name || ' ' || p_type END AS label FROM part""")
def label_truncated(spark, sf_dir):
    names = fixtures.table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name")).distinct()
    return names.withColumn("label", text.shorten(F.col("name")))


# --- files ------------------------------------------------------------------------------------------------------------

def _feature_files(spark, sf_dir, compression) -> str:
    path = session.work_folder(spark, "features-json")
    features.write(features.extract(_flights(spark, sf_dir)), path, compression)
    return path


@query("features", sql=_FEATURES_SELECT)
def io_json_bz2(spark, sf_dir):
    return _plain(readers.json_lines(spark, _feature_files(spark, sf_dir, "bzip2"), schemas.TRAINING_FEATURE))


@query("features", sql=_FEATURES_SELECT)
def io_json_text(spark, sf_dir):
    return _plain(readers.json_text(spark, _feature_files(spark, sf_dir, None), schemas.TRAINING_FEATURE))


@query("features", sql="""SELECT FlightNum, FlightDate, DayOfWeek, Carrier, Origin, Dest, Distance, DepDelay, ArrDelay
 FROM features""")
def io_json_inferred(spark, sf_dir):
    inferred = readers.json_lines(spark, _feature_files(spark, sf_dir, None))
    return _plain(inferred.select("FlightNum", "FlightDate", F.col("DayOfWeek").cast("int").alias("DayOfWeek"),
                                  "Carrier", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay"))


@query("features", sql=_FEATURES_SELECT)
def io_parquet_convert(spark, sf_dir):
    source = _feature_files(spark, sf_dir, None)
    target = session.work_folder(spark, "features-parquet")
    writers.json_to_parquet(spark, source, target, schemas.TRAINING_FEATURE)
    return _plain(readers.parquet_view(spark, target, "flight_features"))


@query("distances", sql="SELECT Origin AS origin, Dest AS dest, CAST(trunc(Distance) AS INT) AS distance FROM distances")
def io_distance_import(spark, sf_dir):
    files, versions = session.work_folder(spark, "distances-json"), session.work_folder(spark, "distances")
    made = features.distances(_flights(spark, sf_dir))
    features.write_distances(made, f"{files}/all")
    features.write_distances(made.where("Origin = 'NATION_3'"), f"{files}/some")
    features.import_distances(spark, f"{files}/all", f"{versions}/1")
    return features.import_distances(spark, f"{files}/some", f"{versions}/2", f"{versions}/1")


_STORED_SQL = """
SELECT UUID, Carrier, Origin, Dest, FlightNum, FlightDate, DepDelay, CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS dt
FROM requests"""


@query("requests", sql=_STORED_SQL)
def io_day_partition(spark, sf_dir):
    base = session.work_folder(spark, "tasks")
    tasks = _typed_requests(spark, sf_dir)
    daily.fetch_all_requests(tasks, base)
    daily.fetch_requests(tasks, base, _DAY)
    stored = readers.day_partition(spark, base, schemas.STREAM_REQUEST)
    return _plain(stored.select(*_REQUEST_COLUMNS, "dt"))


@query("requests", sql=f"""
SELECT UUID, Carrier, Origin, Dest, FlightNum, FlightDate, DepDelay, CAST({_RULE_SQL} AS DOUBLE) AS Prediction
FROM requests WHERE "Timestamp" >= DATE '{_DAY}' AND "Timestamp" < DATE '{_DAY}' + 1""")
def load_day_results(spark, sf_dir):
    base, table = session.work_folder(spark, "results"), session.work_folder(spark, "result-table")
    scored = _ruled(training.with_route(_typed_requests(spark, sf_dir)))
    writers.replace_days(scored.withColumn("dt", F.col("Timestamp").cast("date")), base)
    for _ in range(2):
        daily.load_results(spark, base, table, _DAY, daily.result_schema(schemas.STREAM_REQUEST))
    loaded = readers.collection(spark, "parquet", path=table)
    return _plain(loaded.select(*_REQUEST_COLUMNS, "Prediction"))


# --- models -----------------------------------------------------------------------------------------------------------

def _judged(spark, sf_dir):
    known = _flights(spark, sf_dir).where("ArrDelay IS NOT NULL AND DepDelay IS NOT NULL")
    return known.select(aggregates.bucket_delay(F.col("ArrDelay")).alias(training.LABEL),
                        aggregates.bucket_delay(F.col("DepDelay")).alias(training.PREDICTION))


_JUDGED_SQL = """(SELECT CASE WHEN ArrDelay < -15 THEN 0.0 WHEN ArrDelay < 0 THEN 1 WHEN ArrDelay < 30 THEN 2 ELSE 3 END
 AS label, CASE WHEN DepDelay < -15 THEN 0.0 WHEN DepDelay < 0 THEN 1 WHEN DepDelay < 30 THEN 2 ELSE 3 END AS guess
FROM features)"""


@query("features", sql=f"""
SELECT avg(CASE WHEN label = guess THEN 1 ELSE 0 END) AS accuracy FROM {_JUDGED_SQL}""")
def accuracy(spark, sf_dir):
    return aggregates.accuracy(_judged(spark, sf_dir), training.LABEL, training.PREDICTION)


@query("features", sql=f"""
SELECT CAST(label AS DOUBLE) AS ArrDelayBucket, CAST(guess AS DOUBLE) AS Prediction, count(*) AS "rows"
FROM {_JUDGED_SQL} GROUP BY 1, 2""")
def confusion(spark, sf_dir):
    return aggregates.confusion(_judged(spark, sf_dir), training.LABEL, training.PREDICTION)


@query("features", sql=f"""
SELECT {_md5_bucket('row_key', '5')} = 0 AS held_out, CAST(label AS DOUBLE) AS ArrDelayBucket, count(*) AS "rows" FROM (
 SELECT *, CASE WHEN ArrDelay < -15 THEN 0 WHEN ArrDelay < 0 THEN 1 WHEN ArrDelay < 30 THEN 2 ELSE 3 END AS label
 FROM features) GROUP BY 1, 2""")
def holdout_split(spark, sf_dir):
    known = _flights(spark, sf_dir).where("ArrDelay IS NOT NULL AND DepDelay IS NOT NULL")
    labelled = known.select("row_key", aggregates.bucket_delay(F.col("ArrDelay")).alias(training.LABEL))
    kept, held = ordering.split_by_key(labelled, F.col("row_key"), 5)
    both = kept.withColumn("held_out", F.lit(False)).unionByName(held.withColumn("held_out", F.lit(True)))
    return both.groupBy("held_out", training.LABEL).agg(F.count(F.lit(1)).alias("rows"))


def predicted_distribution(spark, sf_dir) -> DataFrame:
    """Predicted classes of the training flights. Evaluation has scored every flight already, so none is scored twice."""
    judged = spark.read.parquet(f"{_trained(spark, sf_dir)}/confusion")
    return judged.groupBy(training.PREDICTION).agg(F.sum("rows").alias("count"))


@query("features", sql=f"""
SELECT sum(n) AS scored, round(max(n) / sum(n), 9) AS majority_share, true AS at_least_majority, true AS evaluator_agrees, true AS valid
FROM (SELECT label, count(*) AS n FROM {_JUDGED_SQL} GROUP BY 1)""")
def train_score_distribution(spark, sf_dir):
    """A forest that learned anything is right at least as often as a constant guess, whose share SQL knows.

    The evaluator scores the flights once more; its accuracy is that of the confusion counts.
    """
    judged = spark.read.parquet(f"{_trained(spark, sf_dir)}/confusion")
    known = features.extract(_flights(spark, sf_dir))
    again = training.delay_bucketizer().transform(scoring.score(known, _model(spark, sf_dir)))
    evaluated = training.evaluate(again)
    share = judged.groupBy(training.LABEL).agg(F.sum("rows").alias("n")).agg(
        F.sum("n").alias("scored"), (F.max("n") / F.sum("n")).alias("majority_share"))
    right = judged.agg(
        (F.sum(F.when(F.col(training.LABEL) == F.col(training.PREDICTION), F.col("rows")).otherwise(0)) / F.sum("rows")).alias("accuracy"),
        F.min(F.col(training.PREDICTION).isin(0.0, 1.0, 2.0, 3.0)).alias("valid"))
    return share.join(right, F.lit(True)).select(
        "scored", F.round("majority_share", 9).alias("majority_share"), (F.col("accuracy") >= F.col("majority_share")).alias("at_least_majority"),
        (F.abs(F.col("accuracy") - evaluated) < 1e-9).alias("evaluator_agrees"), "valid")


@query("features", sql=f"""
SELECT CAST(label AS DOUBLE) AS ArrDelayBucket, count(*) AS "rows" FROM {_JUDGED_SQL} GROUP BY 1""")
def train_label_rows(spark, sf_dir):
    """Rows per class that went into training and evaluation."""
    judged = spark.read.parquet(f"{_trained(spark, sf_dir)}/confusion")
    return judged.groupBy(training.LABEL).agg(F.sum("rows").alias("rows"))


def _scored_days(spark, sf_dir) -> DataFrame:
    tasks, results = session.work_folder(spark, "tasks"), session.work_folder(spark, "results")
    daily.fetch_all_requests(_typed_requests(spark, sf_dir), tasks)
    model = _model(spark, sf_dir)
    daily.score_all_days(spark, tasks, results, model, "keep", schemas.STREAM_REQUEST)
    daily.score_day(spark, tasks, results, _DAY, model, "keep", schemas.STREAM_REQUEST)
    return readers.day_partition(spark, results, daily.result_schema(schemas.STREAM_REQUEST))


_CLASSES = [0.0, 1.0, 2.0, 3.0]


@query("requests", sql="""
SELECT UUID, CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS dt, Carrier, Origin || '-' || Dest AS Route, DepDelay, true AS classified
FROM requests""")
def daily_score(spark, sf_dir):
    """Every request with its day, its route and one of the four classes."""
    return _plain(_scored_days(spark, sf_dir).select(
        "UUID", "dt", "Carrier", "Route", "DepDelay", F.coalesce(F.col("Prediction").isin(_CLASSES), F.lit(False)).alias("classified")))


@query("requests", sql="""
SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS dt, count(*) AS scored, count(*) AS classified,
 count(DISTINCT Origin || '-' || Dest) AS routes FROM requests GROUP BY 1""")
def daily_score_days(spark, sf_dir):
    """Scored requests per day: every request once, with a valid class and its route."""
    return _plain(_scored_days(spark, sf_dir).groupBy("dt").agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("Prediction").isin(_CLASSES)).alias("classified"),
        F.count_distinct("Route").alias("routes")))


def _regression(spark, sf_dir) -> training.Regression:
    def make() -> str:
        path = session.work_folder(spark, "regression")
        training.save_regression(training.train_regression(features.extract(_flights(spark, sf_dir))), path)
        return path
    return training.load_regression(spark, _once(spark, sf_dir, "regression", make))


@query("features", sql="""
SELECT count(*) AS scored, round(var_pop(ArrDelay), 6) AS variance, true AS error_at_most_variance,
 round(regr_slope(ArrDelay, DepDelay), 6) AS slope, round(regr_intercept(ArrDelay, DepDelay), 6) AS intercept FROM features""")
def regression_score(spark, sf_dir):
    """The squared error of the regression beside the variance, which a constant guess would leave; and a line by one input."""
    known = features.extract(_flights(spark, sf_dir))
    error = F.avg(F.pow(F.col("Delay") - F.col("ArrDelay"), 2))
    judged = training.score_regression(known, _regression(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("scored"), F.round(F.var_pop("ArrDelay"), 6).alias("variance"),
        (error <= F.var_pop("ArrDelay")).alias("error_at_most_variance"), *training.line_of("DepDelay", "ArrDelay"))
    return judged.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 6)})


@query("requests", sql="SELECT Carrier, count(*) AS scored FROM requests GROUP BY 1")
def regression_rows(spark, sf_dir):
    """Requests with a finite predicted delay per carrier: all of them."""
    finite = F.col("Delay").isNotNull() & ~F.isnan("Delay") & (F.abs("Delay") < 1e6)
    scored = training.score_regression(_typed_requests(spark, sf_dir), _regression(spark, sf_dir))
    return scored.where(finite).groupBy("Carrier").agg(F.count(F.lit(1)).alias("scored"))


@query("requests", sql="SELECT count(*) AS scored, CAST(0 AS BIGINT) AS differing FROM requests")
def model_roundtrip(spark, sf_dir):
    """Requests whose class changes when the chain is saved and loaded again: none."""
    model = _model(spark, sf_dir)
    path = session.work_folder(spark, "model")
    training.save(model, path)
    asked = _typed_requests(spark, sf_dir)
    first = scoring.score(asked, model, "keep").select("UUID", "Prediction")
    second = scoring.score(asked, training.load(spark, path), "keep").select("UUID", F.col("Prediction").alias("again"))
    both = first.join(second, "UUID", "full_outer")
    return both.agg(F.count(F.lit(1)).alias("scored"),
                    F.count_if(~F.col("Prediction").eqNullSafe(F.col("again"))).alias("differing"))


# --- streams ----------------------------------------------------------------------------------------------------------

def _finished(spark, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, into files, and return them; one state partition per core of the cluster."""
    path, checkpoint = session.work_folder(spark, name), session.work_folder(spark, f"{name}-checkpoint")
    cores = spark.sparkContext.defaultParallelism
    jobs.to_files(stream, path, checkpoint, interval=None, partitions=cores).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("requests", sql=_PARSED_SQL)
def stream_parse(spark, sf_dir):
    parsed = stream_messages.parsed(_messages(_event_stream(spark, sf_dir)))
    return _shown_requests(_finished(spark, stream_messages.requests(parsed), "parsed"))


def _repeated(rows: DataFrame) -> DataFrame:
    """Every row one to three times."""
    copies = F.sequence(F.lit(0), (F.col("UUID").cast("bigint") % 3).cast("int"))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


@query("requests", sql=f"""SELECT UUID, Carrier, strftime("Timestamp", {_MICROS}) AS "Timestamp" FROM requests""")
def stream_dedup(spark, sf_dir):
    rows = fixtures.request_rows(_event_stream(spark, sf_dir)).select("UUID", "Carrier", "Timestamp")
    unique = jobs.unique_requests(_repeated(rows), "Timestamp", "1 hour")
    return _finished(spark, unique, "unique").withColumn("Timestamp", times.iso_text(F.col("Timestamp")))


@query("requests", "distances", sql=_request_sql("DepDelay", _ISO_WEEK, "coalesce(d.Distance, 0)"))
def stream_enriched(spark, sf_dir):
    raw = _forms(fixtures.request_rows(_event_stream(spark, sf_dir)))
    made = jobs.enriched(raw, _distances(spark, sf_dir), forms.replayable_id(F.col("request")), as_of=F.col("_at"))
    return _finished(spark, made.drop("_at"), "enriched")


@query("responses", sql=_LATEST_SQL)
def stream_upsert(spark, sf_dir):
    sent = writers.as_messages(_response_messages(_response_rows(_event_stream(spark, sf_dir))))
    path, checkpoint = session.work_folder(spark, "responses"), session.work_folder(spark, "responses-checkpoint")
    jobs.listen_responses(sent, path, schemas.STREAM_RESPONSE, checkpoint, interval=None).awaitTermination()
    return keyed.responses(spark, path)


def _streamed(spark, sf_dir) -> tuple[DataFrame, str]:
    """Score all request messages as a stream; the response table and the folder of the other outputs."""
    path = session.work_folder(spark, "scored")
    jobs.score_stream(
        _messages(_event_stream(spark, sf_dir)), _model(spark, sf_dir),
        [writers.message_log(f"{path}/messages"), jobs.response_sink(f"{path}/table")], f"{path}/checkpoint",
        reject_sink=writers.row_log(f"{path}/rejects"), interval=None).awaitTermination()
    return keyed.responses(spark, f"{path}/table"), path


@query("requests", sql="""
SELECT UUID AS uuid, Carrier AS carrier, Origin AS origin, Dest AS dest, DepDelay AS depdelay, Origin || '-' || Dest AS route,
 true AS classified FROM requests WHERE event_id % 41 <> 0 AND event_id % 43 <> 0""")
def stream_scored(spark, sf_dir):
    """Every well-formed message with its route and one of the four classes."""
    return _streamed(spark, sf_dir)[0].select(
        "uuid", "carrier", "origin", "dest", "depdelay", "route", F.coalesce(F.col("prediction").isin(_CLASSES), F.lit(False)).alias("classified"))


@query("requests", sql="""
SELECT count(*) FILTER (event_id % 41 <> 0 AND event_id % 43 <> 0) AS answered,
 count(*) FILTER (event_id % 41 = 0 OR event_id % 43 = 0) AS rejected, CAST(0 AS BIGINT) AS differing FROM requests""")
def stream_equals_batch(spark, sf_dir):
    """The streamed classes beside those of a batch over the same messages: none differs."""
    streamed, path = _streamed(spark, sf_dir)
    parsed = stream_messages.parsed(_messages(fixtures.table(spark, sf_dir, "events")))
    batch = scoring.score(stream_messages.requests(parsed), _model(spark, sf_dir), "keep")
    both = batch.select(F.col("UUID").alias("uuid"), "Prediction").join(
        streamed.select("uuid", F.col("prediction").alias("streamed")), "uuid", "full_outer")
    rejected = spark.read.parquet(f"{path}/rejects").agg(F.count(F.lit(1))).scalar()
    return both.agg(F.count("streamed").alias("answered"),
                    F.count_if(~F.col("Prediction").eqNullSafe(F.col("streamed"))).alias("differing")
                    ).withColumn("rejected", rejected)


@query("requests", "responses", sql="""
SELECT r.UUID AS request_uuid, any_value(r.Carrier) AS Carrier, min_by(p.Prediction, p.ResponseTime) AS Prediction,
 strftime(min(p.ResponseTime), '%Y-%m-%d %H:%M:%S') AS ResponseTime
FROM requests r JOIN responses p ON r.UUID = p.UUID AND p.ResponseTime >= r."Timestamp"
 AND p.ResponseTime <= r."Timestamp" + INTERVAL 10 MINUTE GROUP BY r.UUID""")
def stream_status_join(spark, sf_dir):
    """Repeated requests and answers, answers on both sides of the bound: the earliest answer in time of every request that has one."""
    asked = _repeated(fixtures.request_rows(_event_stream(spark, sf_dir)).select("UUID", "Carrier", "Timestamp"))
    answers = _repeated(_response_rows(_event_stream(spark, sf_dir)).select("UUID", "ResponseTime", "Prediction"))
    paired = jobs.request_response(asked, answers, "Timestamp", "ResponseTime", "10 MINUTES", "1 hour")
    pairs = _finished(spark, paired.select("request_uuid", "Carrier", "ResponseTime", "Prediction"), "paired")
    return _plain(jobs.first_answers(pairs, "ResponseTime"))
