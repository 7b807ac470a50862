"""Many tables from one pass."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docsheaf.plans import ColumnSpec, ExportSpec, export, export_routed, route
from docsheaf.session import fresh_dir
from docsheaf.sources import DocTable

SCHEMA = "id string, day date, kind string, count string, visits array<struct<n:string,items:array<struct<id:string,w:int>>>>, one struct<z:int>"
ROWS = [
    ("a", dt.date(2024, 1, 1), "x", "1", [("1", [(None, 1), ("i", 2)]), ("no", None)], (5,)),
    ("b", dt.date(2024, 1, 3), "y", "many", [], None),
    ("c", None, "x", None, None, None),
]
DOCS = ExportSpec("docs", "form", (ColumnSpec("id", ("id",)), ColumnSpec("count", ("count",), data_type="integer"), ColumnSpec("none", ("absent",)),
                                   ColumnSpec("kind", ("kind",), mapping="kinds")), missing_value="---")
VISITS = ExportSpec("visits", "form", (ColumnSpec("id", ("id",)), ColumnSpec("n", ("n",), data_type="integer")), root=("visits", "[*]"), value_or_root=True)
ITEMS = ExportSpec("items", "form", (ColumnSpec("id", ("id",)), ColumnSpec("w", ("w",)), ColumnSpec("doc", ("$", "id"))), root=("visits", "items"), filters=(("kind", "x"),))
ONE = ExportSpec("one", "form", (ColumnSpec("id", ("id",)), ColumnSpec("z", ("z",))), root=("one",))
SPECS = [DOCS, VISITS, ITEMS, ONE]


@pytest.fixture
def source(spark):
    return DocTable(spark.createDataFrame(ROWS, SCHEMA), "form")


@pytest.fixture
def mappings(spark):
    return spark.createDataFrame([("kinds", "x", "ex"), ("other", "y", "no")], "name string, source string, destination string")


def bag(df):
    return sorted(map(repr, df.collect()))


def test_same_rows_as_single_exports(spark, source, mappings):
    tables, counts = export_routed(source, SPECS, fresh_dir(spark, "routed"), mappings, ["day"])
    for spec in SPECS:
        alone = export(source, spec, mappings)
        assert bag(tables.table(spec.table)) == bag(alone), spec.table
        assert tables.table(spec.table).dtypes == alone.dtypes
        assert counts[spec.table].rows == alone.count()
    assert counts["docs"].nulls == {"id": 0, "count": 2, "none": 0, "kind": 0} and counts["docs"].newest == dt.date(2024, 1, 3)
    assert counts["items"].newest == dt.date(2024, 1, 1) and counts["one"].rows == 1


def test_same_rows_from_documents_without_a_schema(spark, source, mappings):
    docs = source.df.select(F.to_variant_object(F.struct("*")).alias("doc"))
    untyped = DocTable(docs, "form", variant="doc")
    tables, _ = export_routed(untyped, SPECS, fresh_dir(spark, "routed"), mappings)
    for spec in SPECS:
        assert bag(tables.table(spec.table)) == bag(export(untyped, spec, mappings)), spec.table


def test_rejects_come_from_the_same_pass(spark, source, mappings):
    tables, counts = export_routed(source, SPECS, fresh_dir(spark, "routed"), mappings)
    assert sorted(map(tuple, tables.rejects().collect())) == [("docs", "b", "count", "many"), ("visits", "a", "n", "no")]
    assert (counts["docs"].rejected, counts["visits"].rejected, counts["items"].rejected) == (1, 1, 0)


def test_one_scan_and_no_shuffle(spark, source, mappings):
    folder = fresh_dir(spark, "source")
    source.df.write.parquet(folder)
    rows = route(DocTable(spark.read.parquet(folder), "form"), SPECS[:1] + SPECS[1:], mappings)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and plan.count("Generate explode") == 1
    plain = route(DocTable(spark.read.parquet(folder), "form"), [replace(DOCS, columns=DOCS.columns[:2]), VISITS, ITEMS])
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "day" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_columns_without_a_value_are_known(spark, source, mappings):
    spec = ExportSpec("t", "form", (ColumnSpec("id", ("id",)), ColumnSpec("later", ("one", "z")), ColumnSpec("never", ("absent",)), ColumnSpec("told", ("absent",), data_type="date")))
    _, counts = export_routed(source, [spec], fresh_dir(spark, "routed"))
    assert counts["t"].born(spec) == ["id", "later", "told"]


def test_empty_sources_and_equal_names(spark, source):
    empty = DocTable(source.df.limit(0), "form")
    tables, counts = export_routed(empty, [VISITS, ITEMS], fresh_dir(spark, "routed"))
    assert counts["visits"].rows == 0 and tables.table("items").collect() == [] and tables.rejects().count() == 0
    with pytest.raises(ValueError, match="two specs"):
        route(source, [VISITS, VISITS])
