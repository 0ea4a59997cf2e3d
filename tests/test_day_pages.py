import glob

import pytest
from pyspark.sql import functions as F

from skyledger.operators import aggregates, documents
from skyledger.plans import day_pages
from tests.conftest import rows

SCHEMA = "FlightDate string, Year int, Month int, Carrier string, TailNum string"


def flights(spark, *made):
    return spark.createDataFrame([(d, int(d[:4]), int(d[5:7]), c, t) for d, c, t in made], SCHEMA)


DAYS = [("2020-01-01", "A", "t1"), ("2020-01-01", "A", "t2"), ("2020-01-31", "B", None), ("2020-02-01", "A", "t1"), ("2020-02-01", "B", None), ("2020-02-02", "A", "t3")]


def same_as_recomputed(spark, base, everything):
    assert rows(day_pages.flights_by_month(spark, base)) == rows(aggregates.flights_by_month(everything))
    assert rows(day_pages.flights_per_airplane(spark, base)) == rows(documents.flights_per_airplane(
        everything.withColumns({"FlightNum": F.lit("1"), "Origin": F.lit("x"), "Dest": F.lit("y")})).select("TailNum", "FlightCount").distinct())
    assert rows(day_pages.fleet_counts(spark, base)) == rows(documents.fleet_counts(everything))
    assert rows(day_pages.fleet_estimates(spark, base)) == rows(documents.fleet_counts(everything))


def test_days_one_by_one_equal_the_whole(spark, tmp_path):
    base = str(tmp_path / "s")
    for day in ("2020-02-01", "2020-01-01", "2020-02-02", "2020-01-31", "2020-02-01"):
        day_pages.update(spark, base, flights(spark, *[r for r in DAYS if r[0] == day]))
    same_as_recomputed(spark, base, flights(spark, *DAYS))


def test_corrected_and_emptied_days(spark, tmp_path):
    base = str(tmp_path / "s")
    day_pages.update(spark, base, flights(spark, *DAYS))
    files = lambda: sorted(set(glob.glob(f"{base}/*/period=2020-02/*.parquet")))
    untouched = files()
    assert untouched
    day_pages.update(spark, base, flights(spark, ("2020-01-01", "C", "t9")))
    assert files() == untouched  # other months are not written
    pruned = day_pages.states(spark, base, "months", F.col("period") == "2020-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in pruned
    left = [("2020-01-01", "C", "t9"), *DAYS[2:]]
    same_as_recomputed(spark, base, flights(spark, *left))
    listed = spark.createDataFrame([("2020-02-01",), ("2020-02-02",), (None,)], "dt string")
    day_pages.update(spark, base, flights(spark, ("2019-12-31", "Z", "z")), listed)  # flights of days that are not listed are left out
    same_as_recomputed(spark, base, flights(spark, *[r for r in left if r[0] < "2020-02"]))


def test_nothing(spark, tmp_path):
    base = str(tmp_path / "s")
    day_pages.update(spark, base, flights(spark, DAYS[0]))
    day_pages.update(spark, base, flights(spark, DAYS[0]).where("Year = 0"))
    assert day_pages.flights_by_month(spark, base).count() == 1


def test_sketch_error_holds(spark, tmp_path):
    many = spark.range(60_000).select(F.lit("2020-01-01").alias("FlightDate"), F.lit(2020).alias("Year"), F.lit(1).alias("Month"),
                                      F.concat(F.lit("C"), F.col("id") % 3).alias("Carrier"), F.concat(F.lit("t"), F.col("id") % 45_000).alias("TailNum"))
    base = str(tmp_path / "s")
    day_pages.update(spark, base, many.where("FlightDate = '2020-01-01'"))
    for row in day_pages.fleet_estimates(spark, base).collect():
        assert row.estimate == pytest.approx(15_000, rel=day_pages.sketch_error())
    assert 0.04 < day_pages.sketch_error() < 0.05


def test_a_first_state_is_written_once(spark, tmp_path, monkeypatch):
    """Without a state nothing is read that is overwritten, so nothing is written aside but what several tables are made of."""
    base, turns = str(tmp_path / "s"), iter(("first", "second"))
    monkeypatch.setattr(day_pages, "work_folder", lambda spark, name: str(tmp_path / next(turns)))
    day_pages.update(spark, base, flights(spark, *DAYS))
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(str(tmp_path / "first" / "*"))) == ["days", "flights"]
    same_as_recomputed(spark, base, flights(spark, *DAYS))
    day_pages.update(spark, base, flights(spark, *DAYS))
    assert len(glob.glob(str(tmp_path / "second" / "*"))) == 6
    same_as_recomputed(spark, base, flights(spark, *DAYS))
