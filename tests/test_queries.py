"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_registered():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) - set(ORACLE) == {"trend_classifier"}


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns == ["start_time", "end_time", "topic", "count", "burst_score", "rank"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) is None
