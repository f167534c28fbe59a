"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from registry.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    verdict, _ = compare(spark, database, FOLDER, name)
    assert verdict == "ok"


def test_checks_belong_to_queries(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).columns) == 33
