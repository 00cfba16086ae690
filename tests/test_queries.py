"""Every registered query against its SQL, on the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from catalog import ORACLES, QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    problem = difference(spark, db, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert problem in (None, "no rows")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_the_catalogue_is_offered():
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
