import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import directory

ORDER = ("d", "k")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(4)
    values = [(i, rng.choice([None, "a", "b", "c"]) if i % 3 else "hot", rng.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(values, "k int, g string, d int").withColumn("d", F.when(F.col("d") != 7, F.col("d"))).repartition(7)
    path = str(tmp_path_factory.mktemp("ordered"))
    directory.write_ordered(df, path, ORDER, rows_per_range=150)
    return df, path


def in_order(df, condition=None):
    found = (df if condition is None else df.where(condition)).collect()
    return sorted(found, key=lambda r: (r.d is None, r.d, r.k) if r.d is not None else (True, 0, r.k))


def test_directory_counts_every_range(spark, made):
    df, path = made
    entries = sorted(directory.directory_of(spark, path).collect(), key=lambda r: r.before)
    assert len(entries) >= 10 and sum(e.rows for e in entries) == 2000
    assert all(a.before + a.rows == b.before for a, b in zip(entries, entries[1:], strict=False))


@pytest.mark.parametrize(("start", "size"), [(0, 10), (145, 20), (1, 700), (1990, 30), (2000, 10), (5000, 10)])
def test_pages_at_any_depth(spark, made, start, size):
    df, path = made
    for condition in (None, F.col("g") == "hot", F.col("g").isNull(), F.col("g") == "nobody"):
        want = [(start + n + 1, r.k) for n, r in enumerate(in_order(df, condition)[start:start + size])]
        page = directory.page(spark, path, ORDER, start, size, condition)
        assert page.columns == ["k", "g", "d", "position"]
        assert sorted((r.position, r.k) for r in page.collect()) == want


def test_a_deep_page_reads_one_range(spark, made):
    df, path = made
    entries = {e.file: e for e in directory.directory_of(spark, path).collect()}
    deep = max(entries.values(), key=lambda e: e.before)
    for page in (directory.page(spark, path, ORDER, deep.before + 3, 10), directory.page(spark, path, ORDER, 600, 10, F.col("g") == "hot")):
        read = {name.rsplit("/", 1)[1] for name in page.inputFiles()}
        assert 1 <= len(read) <= 2 and "Exchange rangepartitioning" not in page._jdf.queryExecution().toString()
    plain = directory.page(spark, path, ORDER, deep.before + 3, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plain and "GreaterThanOrEqual(_place" in plain


def test_many_pages(spark, made):
    df, path = made
    asked = spark.createDataFrame([(1, 0), (2, 145), (3, 145), (4, 1995), (5, 9999), (6, -4)], "request int, start int")
    everything = [r.k for r in in_order(df)]
    want = sorted((n, p + 1, everything[p]) for n, s in [(1, 0), (2, 145), (3, 145), (4, 1995), (6, 0)] for p in range(s, min(s + 10, 2000)))
    found = directory.pages(spark, path, asked, 10)
    assert sorted((r.request, r.position, r.k) for r in found.collect()) == want
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_positions_and_empty(spark, made, tmp_path):
    df, path = made
    assert sorted((r.position, r.k) for r in directory.positions(spark, path).collect()) == [(n + 1, r.k) for n, r in enumerate(in_order(df))]
    empty = str(tmp_path / "empty")
    directory.write_ordered(df.where("k < 0"), empty, ORDER)
    assert directory.page(spark, empty, ORDER, 0, 10).count() == 0 == directory.pages(spark, empty, df.selectExpr("k AS request", "0 AS start"), 3).count()


def test_numbered_spreads_a_hot_key(spark, made, tmp_path):
    """Two thirds of the rows have one key: it lies in several ranges, and places are still those of row_number."""
    df, _ = made
    path = str(tmp_path / "n")
    directory.write_numbered(df, path, ("g",), ("d", "k"), 100)
    df.createOrReplaceTempView("numbered_rows")
    want = spark.sql("""SELECT k, row_number() OVER (PARTITION BY g ORDER BY d NULLS LAST, k) AS p, count(*) OVER (PARTITION BY g) AS n FROM numbered_rows""")
    found = directory.numbered(spark, path, ["g"])
    assert sorted((r.k, r.position, r.position_of) for r in found.collect()) == sorted(map(tuple, want.collect()))
    assert directory.rows_of(spark, path).where("g = 'hot'").select("_range").distinct().count() > 4
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
