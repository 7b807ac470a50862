"""Lists in lists, and lists and members of documents without a schema."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsheaf.functions import attachment_url, call, variant_descendants, via
from docsheaf.plans import ColumnSpec, ExportSpec, export
from docsheaf.sources.tables import DocTable

TYPE = "struct<id:string,visits:array<struct<id:string,day:int,items:array<struct<id:string,n:int>>>>>"
SPEC = ExportSpec("items", "form", (ColumnSpec("id", ("id",)), ColumnSpec("n", ("n",), data_type="integer")), root=("visits", "[*]", "items", "[*]"))


def table(spark, docs, variant):
    texts = spark.createDataFrame([(json.dumps(x),) for x in docs], "t string")
    if variant:
        return DocTable(texts.select(F.parse_json("t").alias("doc")), "form", variant="doc")
    return DocTable(texts.select(F.from_json("t", TYPE).alias("d")).select("d.*"), "form")


def ids(spark, docs, variant, spec=SPEC):
    return {r["n"]: r["id"] for r in export(table(spark, docs, variant), spec).collect()}


@pytest.mark.parametrize("variant", [False, True])
def test_an_item_more_renames_nothing_elsewhere(spark, variant):
    visits = [{"day": 1, "items": [{"n": 1}, {"n": 2}]}, {"day": 2, "items": []}, {"day": 3, "items": [{"n": 3}]}]
    before = ids(spark, [{"id": "d", "visits": visits}], variant)
    assert before == {1: "d.visits.[0].items.[0]", 2: "d.visits.[0].items.[1]", 3: "d.visits.[2].items.[0]"}
    visits[0]["items"].append({"n": 4})
    visits[1]["items"].append({"n": 5})
    after = ids(spark, [{"id": "d", "visits": visits}], variant)
    assert {n: after[n] for n in before} == before
    assert after[4] == "d.visits.[0].items.[2]" and after[5] == "d.visits.[1].items.[0]"


@pytest.mark.parametrize("variant", [False, True])
def test_elements_with_ids_are_called_by_them(spark, variant):
    docs = [{"id": "d", "visits": [{"id": "v", "items": [{"n": 1}, {"id": "x", "n": 2}]}, {"items": [{"n": 3}]}]}, {"id": "e", "visits": None}]
    assert ids(spark, docs, variant) == {1: "d.visits.v.items.[0]", 2: "d.visits.v.items.x", 3: "d.visits.[1].items.[0]"}


@pytest.mark.parametrize("variant", [False, True])
def test_numbers_count_in_the_whole_list(spark, variant):
    docs = [{"id": "d", "visits": [{"items": [{"n": 10 * v + i} for i in range(3)]} for v in range(3)]}]
    root = lambda *steps: ExportSpec("t", "form", SPEC.columns, root=steps)
    assert ids(spark, docs, variant, root("visits", "[-1]", "items")) == {20: "d.visits.[2].items.[0]", 21: "d.visits.[2].items.[1]", 22: "d.visits.[2].items.[2]"}
    assert ids(spark, docs, variant, root("visits", "[1:]", "items", "[::2]")) == {
        10: "d.visits.[1].items.[0]", 12: "d.visits.[1].items.[2]", 20: "d.visits.[2].items.[0]", 22: "d.visits.[2].items.[2]"}


@pytest.mark.parametrize("variant", [False, True])
def test_documents_without_items_keep_their_row(spark, variant):
    docs = [{"id": "d", "visits": [{"items": []}, {"items": [{"n": 1}]}]}, {"id": "e", "visits": [{"items": []}]}, {"id": "f", "visits": []}]
    spec = ExportSpec("t", "form", SPEC.columns, root=SPEC.root, value_or_root=True)
    rows = export(table(spark, docs, variant), spec).collect()
    assert sorted((r["id"], r["n"]) for r in rows if r["n"]) == [("d.visits.[1].items.[0]", 1)]
    assert sorted(r["id"] for r in rows if r["n"] is None) == ["e", "f"]


def test_lone_values_are_lists_of_one_without_a_number(spark):
    docs = [{"id": "d", "visits": {"day": 1, "items": {"n": 7}}}, {"id": "e", "visits": [{"items": {}}, {"items": [{"n": 8}]}]}]
    assert ids(spark, docs, True) == {7: "d.visits.items", 8: "e.visits.[1].items.[0]"}


def test_nothing_moves(spark):
    plan = export(table(spark, [{"id": "d", "visits": []}], False), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1


def test_long_lists_without_a_schema_cost_no_square(spark):
    """A row carries no whole document, and no element asks again what the list around it is."""
    spec = ExportSpec("t", "form", (*SPEC.columns, ColumnSpec("who", ("$", "meta", "user")), ColumnSpec("doc", ("$", "id"), data_type="text")), root=SPEC.root)
    docs = [{"id": "d", "meta": {"user": "u"}, "visits": [{"items": [{"n": i} for i in range(3000)]}, {"id": "v", "items": [{"n": 3000}]}]}]
    out = export(table(spark, docs, True), spec)
    generate = re.search(r"Generate posexplode.*, \[([^\]]*)\], (?:true|false), \[__pos", out._jdf.queryExecution().optimizedPlan().toString())
    # Of the columns below, the first one, which is the document, goes no further.
    assert generate and generate[1] == "0"
    assert "schema_of_variant" not in generate[0].lower().replace("schemaofvariant", "schema_of_variant")
    rows = {r["n"]: r for r in out.collect()}
    assert len(rows) == 3001 and rows[2999]["id"] == "d.visits.[0].items.[2999]" and rows[3000]["id"] == "d.visits.v.items.[0]"
    assert {(r["who"], r["doc"]) for r in rows.values()} == {("u", "d")}


def variants(spark, *values):
    return spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string").select("i", F.parse_json("t").alias("v"))


def test_unique_and_len_by_kind(spark):
    docs = variants(spark, ["p", "q", "p"], [3, 1, 2.5, 1.0, 10], "red", None, [{"b": 1, "a": 2}, {"a": 2, "b": 1}], [], {"x": 1, "y": 2}, ["a b", "a", None, True, 1])
    kind = docs.schema["v"].dataType
    rows = docs.orderBy("i").select(F.to_json(via("unique", dtype=kind)(F.col("v"))).alias("u"), via("len", dtype=kind)(F.col("v")).alias("n")).collect()
    assert [json.loads(r["u"]) for r in rows] == [["p", "q"], [1, 2.5, 3, 10], "red", None, [{"a": 2, "b": 1}], [], {"x": 1, "y": 2}, [None, True, 1, "a", "a b"]]
    assert [r["n"] for r in rows] == [3, 5, 3, None, 2, 0, 2, 5]


def test_lists_give_the_same_typed_and_not(spark):
    spec = ExportSpec("t", "form", (
        ColumnSpec("u", ("visits", "[*]", "day"), map_via=("unique",)), ColumnSpec("n", ("visits", "[*]", "day"), map_via=("len",), data_type="text"),
        ColumnSpec("both", ("visits", "day"), map_via=("unique",), format_via=("len",), data_type="text")))
    docs = [{"id": "d", "visits": [{"day": 2}, {"day": 10}, {"day": 2}]}]
    typed, untyped = (export(table(spark, docs, v), spec).first() for v in (False, True))
    assert typed["u"] == untyped["u"] == "2,10" and typed["n"] == untyped["n"] == "3" and typed["both"] == "2"


def test_descendants_of_documents_without_a_schema(spark):
    docs = variants(spark, {"x": 3, "a": {"x": 1, "b": {"x": [{"x": 9}]}}, "l": [{"x": "p"}, [{"x": None}], 5], "z": {"x": {"x": 7}}}, 5, [], {"x": {}}, {"a<b<c": {"x": 1}, "x": 2}, [[[[[[{"x": 1}]]]]]])
    found = [json.loads(r[0]) for r in docs.orderBy("i").select(F.to_json(variant_descendants(F.col("v"), "x"))).collect()]
    assert found == [[3, 1, [{"x": 9}], 9, "p", None, {"x": 7}, 7], [], [], [{}], [2, 1], [1]]


def test_descendants_below_lists_of_mixed_kinds(spark):
    """The type of such a list does not say how deep it goes."""
    docs = variants(spark, [1, {"a": {"x": 1}}, [[{"x": "}"}]]], {"l": ["s", {"b": [{"c": {"x": {"x": None}}}, 2]}], "x": "{[<"}, None)
    found = [json.loads(r[0]) for r in docs.orderBy("i").select(F.to_json(variant_descendants(F.col("v"), "x"))).collect()]
    assert found == [[1, "}"], ["{[<", {"x": None}, None], []]


def test_descendants_in_paths(spark):
    docs = [{"id": "d", "form": {"case": {"@id": "1"}, "sub": [{"case": {"@id": "2"}}, {"deep": {"case": {"@id": "3"}}}]}}]
    source = DocTable(variants(spark, *docs).select(F.col("v").alias("doc")), "form", variant="doc")
    rows = export(source, ExportSpec("cases", "form", (ColumnSpec("case_id", ("@id",)),), root=("form", "..case"))).collect()
    assert [r["case_id"] for r in rows] == ["1", "2", "3"]
    assert export(source, ExportSpec("t", "form", (ColumnSpec("all", ("form", "..@id")),))).first()["all"] == "1,2,3"


def test_texts_and_numbers_under_plus(spark):
    row = spark.range(1).select(
        call("+", F.lit("a"), "b", dtype=StringType()).alias("ab"), call("+", F.lit("2.5"), 1, dtype=StringType()).alias("sum"),
        attachment_url("https://h", F.lit("d"), F.lit("f"), F.lit(5)).alias("url")).first()
    assert row["ab"] == "ab" and row["sum"] == 3.5 and row["url"].endswith("/f/5")
