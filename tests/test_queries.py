"""Every check query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import database, difference
from checks.queries import QUERIES
from checks.sql import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) is None


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["label", "tp", "fp", "fn", "support", "precision", "recall", "f1"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
