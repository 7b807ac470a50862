"""Sources: pages, filters, ranges, cursors and related documents."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from docsheaf.session import fresh_dir
from docsheaf.sources import (
    inline_children, keyset_page, match_filters, next_cursor, one_per_id, read_pages,
    read_pages_untyped, related_rows, since_until, since_until_fallback,
)

PAGE_1 = {"meta": {"next": "?offset=1", "offset": 0, "limit": 1, "total_count": 2},
          "objects": [{"id": 1, "foo": 1, "indexed_on": "2024-01-01T00:00:00Z"}]}
PAGE_2 = {"meta": {"next": None, "offset": 1, "limit": 1},
          "objects": [{"id": 1, "foo": 1, "indexed_on": "2024-01-01T00:00:00Z"},
                      {"id": 2, "foo": 2, "indexed_on": "2024-01-01T00:00:00Z"}]}


def test_pages(spark):
    folder = fresh_dir(spark, "pages")
    spark.createDataFrame([(json.dumps(PAGE_1),), (json.dumps(PAGE_2),)], "v string").write.text(folder)
    docs = read_pages(spark, folder, "struct<id:bigint,foo:bigint,indexed_on:string>")
    assert docs.count() == 3
    assert sorted(r["id"] for r in one_per_id(docs, ["id"]).collect()) == [1, 2]
    untyped = read_pages_untyped(spark, folder)
    assert untyped.select(F.try_variant_get("doc", "$.foo", "int").alias("f")).agg(F.sum("f")).first()[0] == 4


def test_one_per_id_is_the_same_however_the_rows_are_split(spark):
    rows = [(i % 3, random.random(), str(i)) for i in range(30)]
    want = {}
    for k, t, v in rows:
        want[k] = max(want.get(k, (0, "")), (t, v))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "id int, t double, v string").repartition(parts)
        assert {r["id"]: (r["t"], r["v"]) for r in one_per_id(df, ["id"], F.col("t")).collect()} == want
    assert one_per_id(spark.createDataFrame([(1,), (1,)], "id int"), ["id"]).count() == 1
    with pytest.raises(Exception, match="without a key"):
        one_per_id(spark.createDataFrame([(None, "x"), (None, "y")], "id int, v string"), ["id"]).collect()
    maps = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "id int, m map<string,int>")
    assert one_per_id(maps, ["id"]).first()["m"] == {"a": 2}


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("a", 2)], "t string, n int")
    kept = match_filters(df, [("t", "a"), ("t", "b"), ("n", 1)])
    assert sorted(r["t"] for r in kept.collect()) == ["a", "b"]
    assert match_filters(df, []).count() == 4


def test_bounds(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d, d) for d in days], "indexed_on timestamp_ntz, date_last_activity timestamp_ntz")
    assert since_until(df, "indexed_on", days[1], days[2]).count() == 2
    assert since_until(df, "date_last_activity", days[1], days[2]).count() == 1
    assert since_until(df, "indexed_on").count() == 3
    assert since_until(df, "indexed_on", until=days[0]).count() == 1


def test_fallback_date(spark):
    rows = [(1, dt.date(2024, 1, 5), None), (2, None, dt.date(2024, 1, 5)), (3, dt.date(2024, 2, 5), dt.date(2024, 1, 5)), (4, None, None)]
    df = spark.createDataFrame(rows, "id int, modified date, received date")
    kept = since_until_fallback(df, [F.col("modified"), F.col("received")], dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]
    assert since_until_fallback(df, [F.col("modified")]).count() == 4


def test_ranges_reach_the_files(spark):
    folder = fresh_dir(spark, "dates")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 5), None)], "id int, m timestamp_ntz, r timestamp_ntz").write.parquet(folder)
    df = spark.read.parquet(folder)
    def pushed(kept):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    day = dt.datetime(2024, 1, 1)
    assert "GreaterThanOrEqual(m," in pushed(since_until(df, "m", day))
    either = pushed(since_until_fallback(df, [F.col("m"), F.col("r")], day, None))
    assert "Or(" in either and "GreaterThanOrEqual(r," in either
    assert "In(id, [1,2])" in pushed(match_filters(df, [("id", 1), ("id", 2)]))


def test_cursor_walks_through_everything(spark):
    df = spark.createDataFrame([(i,) for i in random.sample(range(100), 25)], "k int")
    seen, cursor = [], None
    while True:
        page = keyset_page(df, "k", cursor, 10)
        rows = [r["k"] for r in page.collect()]
        if not rows:
            assert next_cursor(page, "k") is None
            break
        seen += rows
        cursor = next_cursor(page, "k")
    assert seen == sorted(r["k"] for r in df.collect())


def families(spark):
    """One parent has a third of all children, one has none."""
    parents = spark.createDataFrame([(i, f"p{i}") for i in range(8)], "id int, name string")
    rows = [(0, n) for n in range(50)] + [(1 + n % 6, 100 + n) for n in range(100)]
    return parents, spark.createDataFrame(rows, "parent int, child int"), rows


def test_children_inside_parents(spark):
    parents, children, rows = families(spark)
    got = inline_children(parents, children.union(children), "id", "parent", "kids").collect()
    assert sorted((r["id"], k["child"]) for r in got for k in r["kids"]) == sorted(rows + rows), "equal children stay"
    assert sorted(r["id"] for r in got) == list(range(8)) and all(r["name"] == f"p{r['id']}" for r in got)
    assert [r["kids"] for r in got if r["id"] == 7] == [[]]
    assert all(r["kids"] == sorted(r["kids"]) for r in got)


def test_children_next_to_parents(spark):
    parents, children, rows = families(spark)
    got = related_rows(parents, children, "id", "parent", "kid").collect()
    assert sorted((r["id"], r["kid"]["child"]) for r in got if r["kid"]) == sorted(rows)
    assert [r["id"] for r in got if not r["kid"]] == [7]
    assert related_rows(parents, children, "id", "parent", "kid", keep_childless=False).count() == len(rows)


def test_a_further_child_changes_no_other_id(spark):
    from docsheaf.plans import ColumnSpec, ExportSpec, export
    from docsheaf.sources import DocTable
    parents, children, rows = families(spark)
    spec = ExportSpec("t", "case", (ColumnSpec("id", ("id",)), ColumnSpec("child", ("child",))), root=("kids",))

    def ids(kids):
        docs = inline_children(parents, kids.withColumn("id", F.concat(F.lit("k"), "child")), "id", "parent", "kids")
        return {r["child"]: r["id"] for r in export(DocTable(docs, "case"), spec).collect()}

    before = ids(children)
    after = ids(children.union(spark.createDataFrame([(0, -1), (3, 999)], children.schema)))
    assert len(set(before.values())) == len(rows)
    assert {k: after[k] for k in before} == before and len(after) == len(before) + 2