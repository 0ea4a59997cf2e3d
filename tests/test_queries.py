"""Every registered query against its SQL text."""

import duckdb  # noqa: F401
import pytest

import __spark_entry__ as entry_points
from skyledger import catalog
from tests.compare import connect, difference

SQL = catalog.ORACLES
MAY_BE_EMPTY = {"flight_lookup", "route_day_flights", "sample_top6"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, con, name):
    df = entry_points.queries()[name](spark, small)
    assert difference(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(SQL) - MAY_BE_EMPTY))
def test_sql_has_rows(con, name):
    assert con.execute(f"SELECT count(*) FROM ({SQL[name]})").fetchone()[0] > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(SQL) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["Prediction", "count"]
    assert {row.Prediction for row in df.collect()} <= {0.0, 1.0, 2.0, 3.0}
