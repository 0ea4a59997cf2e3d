import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from skyledger.operators import batch_search as bs
from tests.conftest import rows

FIELDS = ("a", "b", "c")


@pytest.fixture(scope="module")
def table(spark):
    made = [(i, f"x{i % 3}", None if i % 7 == 0 else f"One {i % 4} two", i % 5, f"{i % 10}") for i in range(120)]
    return spark.createDataFrame(made, "id int, a string, b string, c int, o string")


def requests(spark, values):
    return spark.createDataFrame([(n, *v) for n, v in enumerate(values)], "request int, a string, b string, c string, start int")


def expected(table, asked, words=(), size=4):
    """Every request on its own, row by row."""
    split = lambda text: set(re.findall(r"\w+", str(text).lower()))
    out = []
    for request in asked.collect():
        hits = []
        for row in table.collect():
            met = True
            for name in FIELDS:
                if request[name]:
                    value = row[name]
                    met &= value is not None and (bool(split(value) & split(request[name])) if name in words else str(value) == request[name])
            if met:
                hits.append(row)
        hits.sort(key=lambda r: (r.o, r.id))
        start = max(request.start or 0, 0)
        page = [(request.request, len(hits), p + 1, hits[p].id) for p in range(start, min(start + size, len(hits)))]
        out += page or [(request.request, len(hits), None, None)]
    return sorted(out, key=str)


def got(found):
    return sorted(map(tuple, found.select("request", "hit_count", "position", "id").collect()), key=str)


def test_all_masks_against_one_by_one(spark, table):
    values = [(a, b, c, start) for a, b, c in product((None, "", "x1", "zz"), (None, "One 2 two"), (None, "3")) for start in (0, 2, 60, None, -3)]
    asked = requests(spark, values)
    assert got(bs.search_many(table, asked, FIELDS, ("o",), ("id",), size=4)) == expected(table, asked)


def test_words_meet_once_however_many_they_share(spark, table):
    asked = requests(spark, [("x1 X2", "two one", None, 0), (None, "TWO;3", None, 0), ("x0", "--", None, 0), (None, "1 1 1", "2", 0), (None, "none", None, 0)])
    found = bs.search_many(table, asked, FIELDS, ("o",), ("id",), words=("a", "b"), size=4)
    assert got(found) == expected(table, asked, ("a", "b"))


def test_missing_columns_and_no_requests(spark, table):
    asked = spark.createDataFrame([(7, "x2")], "request int, a string")
    assert {r.hit_count for r in bs.search_many(table, asked, FIELDS, ("o",), ("id",)).collect()} == {40}
    none = bs.search_many(table, asked.where("request = 0"), FIELDS, ("o",), ("id",))
    assert none.columns == ["request", "start", "hit_count", "position", *table.columns] and none.count() == 0
    empty = bs.search_many(table.where("id < 0"), asked, FIELDS, ("o",), ("id",)).collect()
    assert [(r.request, r.hit_count, r.position) for r in empty] == [(7, 0, None)]


def test_one_scan_one_join_and_early_limit(spark, tmp_path, table):
    """No cross join, one equi-join whatever the masks, ranks limited before the exchange; many equal requests are one criterion."""
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    asked = requests(spark, [(None, None, None, 0)] * 500 + [("x1", None, None, 0), ("x1", None, "1", 0), (None, "b", "1", 0)])
    found = bs.search_many(stored, asked, FIELDS, ("o",), ("id",), size=4)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 2  # one for the counts, one for the ranks
    partial = physical.index("Partial") if "Partial" in physical else -1
    assert "WindowGroupLimit" in physical and partial > 0
    assert found.groupBy("request").count().where("count = 4").count() >= 500
    masks, criteria = [0], asked.select(F.lit("{}").alias("criterion"), *FIELDS).where("a IS NULL AND b IS NULL").distinct()
    assert bs.matched(stored, criteria, masks, FIELDS).count() == 120


def test_tokens(spark):
    df = spark.createDataFrame([("Brand#7, brand é_x",), (None,), ("--",)], "t string")
    assert [r[0] for r in df.select(bs.tokens(F.col("t"))).collect()] == [["brand", "7", "é_x"], None, []]
    assert rows(df.select(bs.given(F.lit("")).alias("g")))[0] == (None,)


def test_few_criteria_meet_the_rows_where_they_are_read(spark, tmp_path, table):
    """A row's keys for all masks are never shuffled when the criteria are few, however the session sizes its broadcasts."""
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    asked = requests(spark, [(a, b, c, 0) for a, b, c in product((None, "x1"), (None, "One 2 two"), (None, "3"))])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bs.search_many(stored, asked, FIELDS, ("o",), ("id",), size=4)
        physical = found._jdf.queryExecution().executedPlan().toString()
        assert any("BroadcastHashJoin [_key" in line for line in physical.splitlines())
        assert got(found) == expected(table, asked)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_row_has_keys_for_asked_values_only(spark, table):
    """With few criteria a row whose values nobody asks for has no key but that of the request without fields; hits stay the same."""
    asked = requests(spark, [("x1", None, None, 0), (None, None, "3", 0), ("x1", None, "3", 0), (None, None, None, 0), ("nobody", None, None, 0)])
    found = bs.search_many(table, asked, FIELDS, ("o",), ("id",), size=4)
    assert got(found) == expected(table, asked)
    criteria = spark.createDataFrame([("m", "x1", None), ("n", None, "3"), ("o", "x1", "3")], "criterion string, a string, c string")
    pairs = bs.matched(table.select("id", "a", "c"), criteria, [1, 2, 3], ("a", "c"), few=True)
    exploded = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert exploded.count("strategy=broadcast") == 3  # the criteria and the values of either field
    per_row = {row.id: (row.a == "x1", row.c == 3) for row in table.collect()}
    assert pairs.count() == sum(a + c + (a and c) for a, c in per_row.values())
