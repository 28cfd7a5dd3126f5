"""Every registered query against its check statement."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from workloads import queries as library

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return connect(SF)


def test_every_library_query_has_a_statement():
    assert set(library.QUERIES) <= set(entry.queries()) and set(library.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(library.QUERIES))
def test_query(spark, engine, name):
    assert compare(entry.queries()[name](spark, SF), engine, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
