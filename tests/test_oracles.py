"""Every registered query beside its DuckDB text."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, database
from tests.conftest import SMALL

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        result = compare(df, con, ORACLES[name])
        assert result.startswith("ok"), result
    else:
        assert df.count() > 0


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["HotelID", "HotelName", "stay_date", "booked_28", "booked_14", "booked_7", "booked_0"]
    assert df.count() > 0
