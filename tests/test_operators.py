"""Relational operators against brute force in Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import aggregates, documents, joins, lookups, ordering, search
from tests.conftest import rows

CARRIERS = ["AA", "DL", "WN"]
PORTS = ["ATL", "SFO", "ORD"]


@pytest.fixture(scope="module")
def flight_rows():
    """Flights of which a third have one tail number, route and day."""
    pick = random.Random(5)
    made = []
    for i in range(900):
        hot = i % 3 == 0
        made.append((
            f"k{i:04}", "WN" if hot else pick.choice(CARRIERS), "ATL" if hot else pick.choice(PORTS),
            "SFO" if hot else pick.choice(PORTS), "N1" if hot else f"N{pick.randrange(2, 40)}",
            str(pick.randrange(1000, 1100)), "2015-01-01" if hot else f"2015-01-{pick.randrange(1, 29):02}",
            None if pick.random() < .05 else f"{pick.randrange(24):02}{pick.randrange(60):02}",
            f"{pick.randrange(24):02}{pick.randrange(60):02}", float(pick.randrange(100, 3000))))
    return made


NAMES = ["row_key", "Carrier", "Origin", "Dest", "TailNum", "FlightNum", "FlightDate", "DepTime", "ArrTime", "Distance"]


@pytest.fixture(scope="module")
def flights(spark, flight_rows):
    return spark.createDataFrame(flight_rows, ", ".join(f"{n} {'double' if n == 'Distance' else 'string'}" for n in NAMES)).repartition(
        7).cache()


def records(flight_rows):
    return [dict(zip(NAMES, row)) for row in flight_rows]


def test_find_one_and_first_per_key(spark, flights, flight_rows):
    best = {}
    for r in records(flight_rows):
        key = (r["Carrier"], r["FlightDate"])
        best[key] = min(best.get(key, r), r, key=lambda x: x["row_key"])
    got = lookups.first_per_key(flights, ["Carrier", "FlightDate"], ["row_key"])
    assert got.columns == flights.columns
    assert {(r.Carrier, r.FlightDate): r.row_key for r in got.collect()} == {k: v["row_key"] for k, v in best.items()}
    one = lookups.find_one(flights, ["row_key"], Carrier="WN", FlightDate="2015-01-01").collect()
    assert [r.row_key for r in one] == [best["WN", "2015-01-01"]["row_key"]]
    assert lookups.find_one(flights, ["row_key"], Carrier="none").count() == 0


def test_latest_per_key_with_null_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4)], "k string, t int, v int")
    assert rows(lookups.latest_per_key(df, ["k"], ["t"])) == [("a", 2, 3), ("b", None, 4)]


def test_first_per_key_has_no_window(flights):
    plan = lookups.first_per_key(flights, ["Carrier"], ["row_key"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan


def test_route_day(flights, flight_rows):
    expected = sorted((r for r in records(flight_rows)
                       if (r["Origin"], r["Dest"], r["FlightDate"]) == ("ATL", "SFO", "2015-01-01")),
                      key=lambda r: (r["DepTime"] is not None, r["DepTime"] or "", r["ArrTime"], r["row_key"]))
    got = lookups.route_day(flights, "ATL", "SFO", "2015-01-01", ["row_key"]).collect()
    assert [r.row_key for r in got] == [r["row_key"] for r in expected]
    assert {r.flight_count for r in got} == {len(expected)}


def searched(flight_rows, test):
    return sorted((r for r in records(flight_rows) if test(r)),
                  key=lambda r: (r["FlightDate"], r["DepTime"] is None, r["DepTime"] or "", r["Carrier"],
                                 r["FlightNum"], r["row_key"]))


@pytest.mark.parametrize("start", [0, 10, 290, 10_000])
def test_search_pages(flights, flight_rows, start):
    expected = searched(flight_rows, lambda r: r["Carrier"] == "WN" and r["Origin"] == "ATL")
    got = search.flight_search(flights, {"Carrier": "wn", "Origin": "ATL", "Dest": None}, schemas.FLIGHT_SEARCH_FIELDS,
                               ties=("row_key",), words=("Carrier",), start=start).collect()
    assert [r.row_key for r in got] == [r["row_key"] for r in expected[start:start + 10]]
    assert all(r.flight_count == len(expected) for r in got)


def test_search_without_filters_or_with_unknown_ones(flights, flight_rows):
    got = search.flight_search(flights, {}, schemas.FLIGHT_SEARCH_FIELDS, ties=("row_key",), size=5).collect()
    assert [r.row_key for r in got] == [r["row_key"] for r in searched(flight_rows, lambda r: True)[:5]]
    assert got[0].flight_count == len(flight_rows)
    with pytest.raises(ValueError):
        search.flight_search(flights, {"Owner": "x"}, schemas.FLIGHT_SEARCH_FIELDS)


def test_search_ignores_missing_sort_columns(flights):
    assert search.flight_search(flights.drop("DepTime"), {}, schemas.FLIGHT_SEARCH_FIELDS, ties=("row_key",)).count() == 10


def test_page_after_walks_all_pages(flights, flight_rows):
    order = ("FlightDate", "ArrTime", "row_key")
    expected = [r["row_key"] for r in sorted(records(flight_rows), key=lambda r: [r[n] for n in order])][:60]
    seen, last = [], ("", "", "")
    while len(seen) < 60:
        page = search.page_after(flights, F.lit(True), order, last, size=20).collect()
        seen += [r.row_key for r in page]
        last = tuple(page[-1][name] for name in order)
    assert seen == expected
    with pytest.raises(ValueError):
        search.page_after(flights, F.lit(True), order, ("x",))


def test_page_is_top_k(flights):
    page = search.flight_search(flights, {"Carrier": "WN"}, schemas.FLIGHT_SEARCH_FIELDS, start=20)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_documents_are_whole(flights, flight_rows):
    got = documents.flights_per_airplane(flights).collect()
    expected = Counter((r["TailNum"], r["Carrier"], r["FlightDate"], r["FlightNum"], r["Origin"], r["Dest"]) for r in records(flight_rows))
    sizes = Counter(r["TailNum"] for r in records(flight_rows))
    assert Counter((r.TailNum, r.Carrier, r.FlightDate, r.FlightNum, r.Origin, r.Dest) for r in got) == expected
    assert all(r.FlightCount == sizes[r.TailNum] for r in got)


def test_one_shape_for_a_tiny_and_a_huge_key(spark):
    df = spark.range(30_001).select(F.when(F.col("id") > 0, "huge").otherwise("tiny").alias("k"), F.col("id").alias("v"))
    got = documents.with_key_count(df, "k", "n")
    assert got.columns == ["k", "v", "n"] and got.count() == 30_001
    assert rows(got.select("k", "n").distinct()) == [("huge", 30_000), ("tiny", 1)]


def test_documents_keep_a_null_key(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("k", "c")], "k string, v string")
    assert rows(documents.with_key_count(df, "k", "n")) == [(None, "a", 2), (None, "b", 2), ("k", "c", 1)]


def test_fleet_and_carriers(spark, flights, flight_rows):
    fleet = {(r["Carrier"], r["TailNum"]) for r in records(flight_rows)}
    sizes = Counter(c for c, _ in fleet)
    got = documents.fleet_per_carrier(flights)
    assert {(r.Carrier, r.TailNum, r.FleetCount) for r in got.collect()} == {(c, t, sizes[c]) for c, t in fleet}
    assert rows(documents.carriers(got)) == [(c,) for c in CARRIERS]
    unknown = spark.createDataFrame([("AA", None), ("AA", None), ("DL", "N1")], "Carrier string, TailNum string")
    assert rows(documents.fleet_per_carrier(unknown)) == [("AA", 0, None), ("DL", 1, "N1")]


def test_chart_is_ordered(spark):
    totals = spark.createDataFrame([(f"m{i}", i // 2) for i in range(50)], "Manufacturer string, Total long")
    got = [(r.Manufacturer, r.Total) for r in documents.chart(totals.repartition(7), "Manufacturer", "Total").collect()]
    assert got == sorted(((f"m{i}", i // 2) for i in range(50)), key=lambda x: (-x[1], x[0]))


DISTANCES = [("ATL", "SFO", 2139.7), ("SFO", "ATL", 2139.7)]


def test_distance_join(spark):
    requests = spark.createDataFrame([(1, "ATL", "SFO"), (2, "ATL", "XXX"), (3, None, "SFO")], "id int, Origin string, Dest string")
    table = spark.createDataFrame(DISTANCES, "Origin string, Dest string, Distance double")
    pick = lambda df: sorted((r.id, r.Distance) for r in df.collect())
    assert pick(joins.with_distance(requests, table)) == [(1, 2139.7), (2, 0.0), (3, 0.0)]
    assert pick(joins.with_distance(requests, table, integer=True)) == [(1, 2139), (2, 0), (3, 0)]
    assert pick(joins.with_distance(requests, table, missing="drop")) == [(1, 2139.7)]
    assert sorted(r.id for r in joins.unknown_routes(requests, table).collect()) == [2, 3]
    assert pick(joins.with_distance(requests, table, spread=4)) == [(1, 2139.7), (2, 0.0), (3, 0.0)]
    assert pick(joins.with_distance(requests, table, "drop", spread=4)) == [(1, 2139.7)]
    with pytest.raises(Exception, match="no distance for ATL XXX"):
        joins.with_distance(requests.where("id = 2"), table, missing="error").collect()


def test_spread_splits_a_hot_route(spark):
    requests = spark.range(2000).select("id", F.lit("ATL").alias("Origin"), F.lit("SFO").alias("Dest"))
    table = spark.createDataFrame(DISTANCES, "Origin string, Dest string, Distance double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.with_distance(requests, table, spread=16).select("Distance", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(joined) == 2000 and {r.Distance for r in joined} == {2139.7}
    assert len({r.p for r in joined}) > 1


def test_airline_page_keeps_both_sides(spark):
    airlines = spark.createDataFrame([("AA", "American"), ("ZZ", "None")], "CarrierCode string, Name string")
    fleet = spark.createDataFrame([("AA", 2), ("WN", 5)], "Carrier string, FleetCount int")
    got = joins.airline_page(airlines, fleet).select("carrier_code", "Name", "FleetCount")
    assert rows(got) == [("AA", "American", 2), ("WN", None, 5), ("ZZ", "None", None)]


def test_request_status(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",)], "UUID string")
    responses = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 3.0), ("c", 1, None)], "UUID string, t int, Prediction double")
    assert rows(joins.request_status(requests, responses, ["t"])) == [
        ("a", 3.0, "OK"), ("b", None, "WAIT"), ("c", None, "OK")]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, None)], "a int, b string").withColumn("c", F.lit(1))
    assert rows(aggregates.null_profile(df)) == [("a", 1), ("b", 3)]
    assert aggregates.null_profile(df.select("c")).count() == 0


@pytest.mark.parametrize("values, expected", [
    ([0.0, 1.0, 9.99, 10.0, None], [(0, 1), (1, 1), (9, 2)]),
    ([5.0, 5.0], [(0, 2)]),
    ([None], []),
    ([-10.0, 0.0], [(0, 1), (9, 1)]),
    ([0.0, 1.0, 10.0, float("nan"), float("inf"), -float("inf")], [(-1, 3), (0, 1), (1, 1), (9, 1)]),
    ([float("nan"), None], [(-1, 1)]),
])
def test_histogram(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert rows(aggregates.histogram(df, "v", 10)) == expected


def test_histogram_by_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 9.9, 10.0, 40.0, 41.0, None)], "v double")
    assert rows(aggregates.histogram_by_edges(df, "v", [0.0, 10.0, 40.0])) == [(0, 2), (1, 2)]
    with pytest.raises(ValueError):
        aggregates.histogram_by_edges(df, "v", [1.0, 0.0])


def test_hash_sample_does_not_depend_on_partitions(flights):
    first = rows(ordering.hash_sample(flights, F.col("row_key"), 5).select("row_key"))
    again = rows(ordering.hash_sample(flights.repartition(3), F.col("row_key"), 5).select("row_key"))
    assert first == again and 100 < len(first) < 260
    assert rows(ordering.hash_sample(flights, F.col("row_key"), 5, seed="27").select("row_key")) != first


def test_split_by_key_is_a_partition(flights):
    kept, held = ordering.split_by_key(flights, F.col("row_key"), 4)
    assert rows(kept.unionByName(held)) == rows(flights) and held.count() > 0


def test_random_sample(flights):
    assert 0 < ordering.random_sample(flights, .3, 27).count() < 900


def test_sorted_files_split_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).select(F.lit("same").alias("a"), F.col("id").alias("b"))
    ordered = ordering.sorted_files(df.repartition(4), ("a",))
    try:
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 3000


def test_top_by(flights, flight_rows):
    got = ordering.top_by(flights, ["ArrTime", "row_key"], 6).collect()
    expected = sorted(records(flight_rows), key=lambda r: (r["ArrTime"], r["row_key"]))[:6]
    assert [r.row_key for r in got] == [r["row_key"] for r in expected]


def test_preview(flights):
    assert lookups.preview(flights).count() == 6


def test_equal_depth_edges_are_within_the_stated_error(spark):
    values = [float(i * i % 9973) for i in range(20_000)] + [float("nan"), float("inf"), -float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    known = sorted(v for v in values if v is not None and v == v and abs(v) != float("inf"))
    edges = spark.range(1).select(aggregates.equal_depth_edges(df, "x", 20).alias("e")).first().e
    slack = aggregates.rank_error(800) * len(known) + 1
    for i, edge in enumerate(edges, 1):
        below, upto = sum(v < edge for v in known), sum(v <= edge for v in known)
        assert below - slack <= len(known) * i / 20 <= upto + slack
    got = aggregates.histogram_equal_depth(df, "x", 20).orderBy("label").collect()
    assert sum(r.value for r in got) == len(known) and got[0].low == known[0] and got[-1].high == known[-1]
    assert all(a.high < b.low for a, b in zip(got, got[1:], strict=False))
    assert max(r.value for r in got) < len(known) / 20 + 2 * slack + 10


def test_equal_depth_of_hot_values(spark):
    """A value that most rows have is one bucket; no rows, no buckets."""
    df = spark.createDataFrame([(5.0,)] * 90 + [(float(i),) for i in range(10)], "x double")
    got = {r.label: (r.low, r.high, r.value) for r in aggregates.histogram_equal_depth(df, "x", 4).collect()}
    assert sum(v for _, _, v in got.values()) == 100 and any(low <= 5.0 <= high and v >= 91 for low, high, v in got.values())
    assert aggregates.histogram_equal_depth(df.where("x < -1"), "x", 4).count() == 0
