"""Set-wise joins.

No join carries a broadcast hint. The adaptive planner knows the size of a shuffled side and broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``; beyond it the join shuffles, and hot keys are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.lookups import latest_per_key

ROUTE_KEY = ["Origin", "Dest"]


def with_distance(requests: DataFrame, distances: DataFrame, missing: str = "zero", integer: bool = False,
                  spread: int = 1) -> DataFrame:
    """Add ``Distance`` by route.

    ``missing`` says what happens to a route without a distance: ``zero`` gives 0, ``error`` fails the job, ``drop``
    leaves the request out (``unknown_routes`` lists those). ``integer`` truncates as the keyed table does. ``spread``
    repeats every distance that many times and deals the requests of a route among the copies; use it where the distances
    do not fit a broadcast and the plan is not adaptive, as in a stream.
    """
    kind = "int" if integer else "double"
    table = distances.select(*ROUTE_KEY, F.col("Distance").cast(kind).alias("Distance"))
    key = list(ROUTE_KEY)
    if spread > 1:
        key.append("_deal")
        requests = requests.withColumn("_deal", F.pmod(F.xxhash64(*requests.columns), F.lit(spread)).cast("int"))
        table = table.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    if missing == "drop":
        return requests.join(table, key, "inner").drop("_deal")
    otherwise = {
        "zero": F.lit(0).cast(kind),
        "error": F.raise_error(F.concat_ws(" ", F.lit("no distance for"), *ROUTE_KEY)).cast(kind),
    }[missing]
    joined = requests.join(table, key, "left").drop("_deal")
    return joined.withColumn("Distance", F.coalesce("Distance", otherwise))


def unknown_routes(requests: DataFrame, distances: DataFrame) -> DataFrame:
    """The requests the strict form leaves out."""
    return requests.join(distances.select(*ROUTE_KEY), ROUTE_KEY, "left_anti")


def airline_page(airlines: DataFrame, counts: DataFrame) -> DataFrame:
    """Airline master data beside the size of its fleet; either side may be missing, and each carrier has one row.

    The tail numbers are a table of their own (``documents.fleet_per_carrier``).
    """
    joined = airlines.join(counts, airlines.CarrierCode == counts.Carrier, "full_outer")
    return joined.withColumn("carrier_code", F.coalesce("CarrierCode", "Carrier"))


def request_status(requests: DataFrame, responses: DataFrame, response_order: list[str]) -> DataFrame:
    """``OK`` and the latest prediction where a response exists, else ``WAIT``."""
    latest = latest_per_key(responses.select("UUID", *response_order, "Prediction"), ["UUID"], response_order)
    answered = latest.select("UUID", "Prediction", F.lit(True).alias("_answered"))
    return (
        requests.join(answered, "UUID", "left")
        .withColumn("status", F.when(F.col("_answered"), F.lit("OK")).otherwise(F.lit("WAIT")))
        .drop("_answered")
    )
