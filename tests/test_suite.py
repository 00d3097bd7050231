"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as suite
from compare_with_sql import connect, difference
from oracle_queries import ORACLES
from tidemark.plans.suite import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(suite.queries()) and set(suite.oracle_sql()) <= set(suite.queries())


def test_entry_has_rows(spark):
    assert suite.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) is None
