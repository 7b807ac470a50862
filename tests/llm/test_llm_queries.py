"""All queries of the subpackage: on awkward rows, on empty tables, and against SQL."""

import pytest

from __spark_entry__ import queries
from check_queries import compare, connect
from docsheaf.llm.queries import QUERIES, SQL

NAMES = sorted(QUERIES) + ["pipeline"]
ROWS = {"op8_html": "pages"}


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, small, name):
    rows = queries()[name](spark, small).collect()
    if name not in ("op2_decontaminate", "pipeline"):
        table = spark.read.parquet(f"{small}/{ROWS.get(name, 'documents')}.parquet")
        assert len(rows) == table.count()
        key = table.columns[0]
        assert sorted(str(r[key]) for r in rows) == sorted(str(r[key]) for r in table.select(key).collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, name):
    assert queries()[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, small, name):
    assert compare(spark, connect(small), small, name) is None


@pytest.mark.parametrize("name", NAMES)
def test_reruns_agree(spark, small, name):
    once, again = (sorted(map(repr, queries()[name](spark, small).collect())) for _ in range(2))
    assert once == again
