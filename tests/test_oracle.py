"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from marquee.plans.queries import QUERIES
from tests.oracle_check import database, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert differences(spark, db, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql())


def test_entry_gives_ten_people(spark):
    assert driver.entry(spark).count() == 10
