"""Flight, airplane, airline and request tables derived from a TPC-H-like schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLIGHT_COLUMNS = (
    "Carrier", "Origin", "Dest", "TailNum", "FlightNum", "FlightDate", "Year", "Month", "DayofMonth", "DayOfWeek",
    "Distance", "DepDelay", "ArrDelay", "CRSDepTime", "CRSArrTime", "WeatherDelay", "row_key",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_items(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """The line items with what the asked columns need of the other tables: keys, codes and a day, no derived text.

    Orders and customers are joined with each other first, which moves the line items through one exchange for both. Every exchange
    moves what the joins before it have added, so the texts of suppliers come last. Each table is joined on its own: the product of two
    is too large in the planner's eyes to be sent to the rows, also where either is small.
    """
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", day.alias("_day"))
    if wanted & {"Dest", "Distance"}:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        order = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(order.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    if "Carrier" in wanted:
        part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("Carrier"))
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    if wanted & {"Origin", "TailNum", "Distance"}:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_name").alias("TailNum"))
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
    return rows


def _named(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Joined line items with the names of nations, a fixed list of some dozen rows: they are sent to the rows, which stay where they are."""
    for key, name in (("s_nationkey", "Origin"), ("c_nationkey", "Dest")):
        if key in rows.columns:
            nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias(name))
            rows = rows.join(F.broadcast(nation), F.col(key) == F.col("_nation")).drop("_nation")
    return rows


def _made(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The asked columns of joined line items."""
    wanted = set(columns)
    day = F.col("_day")
    delay = F.expr("CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 180 AS DOUBLE) - 30")
    departure = F.expr("CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS STRING)")
    arrival = F.expr("CAST(((l_orderkey + 1 + l_suppkey % 5) % 25) * 100 + (l_partkey + 17) % 60 AS STRING)")
    no_departure = F.col("l_linenumber") == 7
    no_arrival = no_departure | ((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"))
    made = {
        "FlightNum": F.expr("CAST(1000 + l_partkey % 5000 AS STRING)"),
        "FlightDate": day.cast("string"),
        "Year": F.year(day),
        "Month": F.month(day),
        "DayofMonth": F.dayofmonth(day),
        "DayOfWeek": F.weekday(day) + 1,
        "Distance": F.expr("CAST(100 + 37 * ((s_nationkey * 7 + c_nationkey * 13) % 60) AS DOUBLE)")
        if "Distance" in wanted else None,
        "DepDelay": F.when(~no_departure, delay),
        "ArrDelay": F.when(~no_arrival, delay + F.col("l_quantity") - 25),
        "CRSDepTime": F.lpad(departure, 4, "0"),
        "CRSArrTime": F.lpad(arrival, 4, "0"),
        "WeatherDelay": F.when(F.col("l_returnflag") == "R", F.col("l_quantity")),
        "row_key": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    }
    return rows.select(*[made[name].alias(name) if name in made else F.col(name) for name in columns])


def flights(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = FLIGHT_COLUMNS) -> DataFrame:
    """One flight per line item.

    Only the joins the asked columns need are made: the foreign keys of these tables always have their row, so leaving
    a join out neither drops nor repeats a flight.
    """
    return _made(_named(spark, sf_dir, _line_items(spark, sf_dir, set(columns))), columns)


def flights_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights with the flights of a date together, by carrier and key.

    The line items are gathered and sorted while they are narrow; the columns, most of them text, are made from them afterwards.
    """
    dated = _named(spark, sf_dir, _line_items(spark, sf_dir, set(FLIGHT_COLUMNS)).hint("rebalance", "_day"))
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return _made(dated.sortWithinPartitions("_day", "Carrier", *keys), FLIGHT_COLUMNS)


def with_page_columns(flights_: DataFrame) -> DataFrame:
    """Columns the pages show besides: actual times and air time."""
    return flights_.withColumns({
        "DepTime": F.col("CRSDepTime"), "ArrTime": F.col("CRSArrTime"), "AirTime": F.col("Distance") / 8})


def airplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airplane per part, owned by a supplier."""
    supplier = table(spark, sf_dir, "supplier")
    owners = supplier.agg(F.count(F.lit(1))).scalar()
    owned = table(spark, sf_dir, "part").withColumn("_owner", F.col("p_partkey") % owners)
    return (
        owned.join(supplier, F.col("_owner") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("TailNum"),
            F.col("s_name").alias("Owner"),
            F.col("n_name").alias("OwnerState"),
            F.col("p_brand").alias("Manufacturer"),
            F.col("p_type").alias("Model"),
            (F.lit(1970) + F.col("p_size")).cast("int").alias("ManufacturerYear"),
            F.col("p_partkey").cast("string").alias("SerialNumber"),
            F.col("p_name").alias("EngineManufacturer"),
            F.concat(F.lit("E"), F.col("p_size").cast("string")).alias("EngineModel"),
        )
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline master data. Two carriers have no entry, and one entry has a code no flight uses."""
    brand = F.col("p_brand")
    codes = table(spark, sf_dir, "part").select(
        F.when(brand == "Brand#5", F.lit("Brand#505")).otherwise(brand).alias("CarrierCode")
    ).where("CarrierCode NOT IN ('Brand#3', 'Brand#11')").distinct()
    slug = F.lower(F.regexp_replace("CarrierCode", "#", ""))
    domain = F.concat(slug, F.lit(".example.com"))
    return codes.select(
        "CarrierCode",
        F.concat(F.lit("Airline "), "CarrierCode").alias("Name"),
        F.concat(F.lit("http://"), domain, F.lit("/")).alias("url"),
        domain.alias("domain"),
        F.concat(F.lit("Summary of "), "CarrierCode").alias("summary"),
        F.concat(F.lit("http://"), domain, F.lit("/logo.png")).alias("logo_url"),
    )


def request_rows(events: DataFrame) -> DataFrame:
    """Requests from event rows, one each; works on the table and on a stream of it."""
    return events.select(
        F.col("event_id").cast("string").alias("UUID"),
        F.col("ts").cast("timestamp").alias("Timestamp"),
        F.expr("concat('Brand#', CAST(event_id % 26 AS STRING))").alias("Carrier"),
        F.expr("CASE WHEN event_id % 97 = 0 THEN 'NATION_99' ELSE concat('NATION_', CAST(event_id % 25 AS STRING)) END")
        .alias("Origin"),
        F.expr("concat('NATION_', CAST(user_id % 25 AS STRING))").alias("Dest"),
        F.expr("CAST(1000 + event_id % 5000 AS STRING)").alias("FlightNum"),
        F.col("ts").cast("date").cast("string").alias("FlightDate"),
        F.col("value").alias("DepDelay"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_rows(table(spark, sf_dir, "events"))


def raw_forms(requests_: DataFrame) -> DataFrame:
    """Requests as form rows: the delay is text, and some of it is not a number."""
    bad = F.col("UUID").cast("bigint") % 50 == 0
    return requests_.withColumn("DepDelay", F.when(bad, F.lit("abc")).otherwise(F.col("DepDelay").cast("string")))
