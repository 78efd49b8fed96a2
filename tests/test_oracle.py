"""Every query against its SQL oracle on the whole small tables."""

import pytest

import __spark_entry__ as driver
import compare
from conftest import SF
from tillstream import catalog, oracle


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF)
    assert compare.difference(df, con, driver.oracle_sql()[name]) is None
