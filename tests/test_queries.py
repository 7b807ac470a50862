"""Every registered query against its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry
from check_queries import compare, connect
from docsheaf.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, name) is None
