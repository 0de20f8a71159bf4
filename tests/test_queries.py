import pytest

import __spark_entry__ as driver
from checks.oracle import ORACLE
from checks.queries import QUERIES
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, odd = compare(
        driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]
    )
    assert rows > 0
    assert odd == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
