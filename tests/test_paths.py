"""Reaching into nested documents."""

import pytest
from pyspark.sql import functions as F

from docsheaf import functions as fn
from docsheaf.operators import child_or_root_rows, child_rows, child_rows_at, is_root_row, present_rows
from docsheaf.plans import ColumnSpec, ExportSpec, export
from docsheaf.sources import DocTable


def docs(spark, schema, *rows):
    import json
    data = [(json.dumps(r),) for r in rows]
    return spark.createDataFrame(data, "j string").select(F.from_json("j", schema).alias("d")).select("d.*")


def test_fields_with_special_names(spark):
    df = docs(spark, "form struct<`@id`:string,`a:1`:int,`#text`:string>", {"form": {"@id": "x", "a:1": 2, "#text": "t"}})
    row = df.select(fn.field("form", "@id"), fn.field("form", "a:1"), fn.field("form", "#text")).first()
    assert tuple(row) == ("x", 2, "t")
    assert df.select(fn.field_or_null(df.schema, "form", "nope").alias("v")).first()["v"] is None


def test_index_and_range(value):
    xs = F.array(*[F.lit(i) for i in range(5)])
    assert value(fn.index_at(xs, 0)) == 0
    assert value(fn.index_at(xs, -1)) == 4
    assert value(fn.index_at(xs, 9)) is None
    assert value(fn.index_range(xs, 1, 3)) == [1, 2]
    assert value(fn.index_range(xs, 3, 1)) == []


def test_gaps_in_a_wildcard(spark):
    schema = "x array<struct<y:int,z:int>>"
    df = docs(spark, schema, {"x": [{"y": 1}, {"y": 2}]}, {"x": [{"y": 3}, {"z": 4}]}, {"x": [{"y": 5}]})
    rows = present_rows(df, F.col("x"), "y", "y")
    assert sorted(r["y"] for r in rows.collect()) == [1, 2, 3, 5]
    assert df.select(fn.each_present(F.col("x"), "y").alias("v")).collect()[1]["v"] == [3]


def test_descendants(spark):
    schema = "case string, form struct<case:string,parts:array<struct<case:string,deep:array<struct<case:string>>>>>"
    df = docs(spark, schema, {
        "case": "a", "form": {"case": "b", "parts": [{"case": "c", "deep": [{"case": "d"}, {}]}, {"case": None}]}})
    out = df.select(fn.descendants(df.schema, "case").alias("v"), fn.descendants(df.schema, "case", "form").alias("w"),
                    fn.descendants(df.schema, "absent").alias("n")).first()
    assert sorted(out["v"]) == ["a", "b", "c", "d"]
    assert sorted(out["w"]) == ["b", "c", "d"]
    assert out["n"] == []


def test_variant_paths(value):
    text = '{"@key":"ship-9","crew.size":41,"voyage":{"legs":[120,75,310],"harbour":{"name":"Brest","berth":null}},"cargo":"salt"}'
    doc = F.parse_json(F.lit(text))
    found = lambda *steps, **how: value(fn.variant_field(doc, *steps, **how))
    assert (found("@key"), found("crew.size", as_type="int"), found("voyage", "harbour", "name")) == ("ship-9", 41, "Brest")
    assert found("voyage", "legs", as_type="array<int>") == [120, 75, 310]
    gaps = [value(fn.variant_missing(doc, *steps)) for steps in (("voyage", "captain"), ("voyage", "harbour", "berth"), ("cargo",))]
    assert gaps == [True, False, False]
    texts = lambda *steps: value(F.transform(fn.variant_list(fn.variant_field(doc, *steps, as_type="variant")), lambda x: F.to_json(x)))
    assert texts("voyage", "legs") == ["120", "75", "310"] and texts("cargo") == ['"salt"']


def test_dynamic_name(value):
    prices = F.create_map(*[F.lit(x) for pair in (("small", 3), ("large", 8)) for x in pair])
    sizes = F.create_map(*[F.lit(x) for pair in (("cup", "small"), ("jug", "large"), ("vat", "giant")) for x in pair])
    got = {what: value(fn.dynamic_field(prices, fn.dynamic_field(sizes, F.lit(what)))) for what in ("cup", "jug", "vat", "pan")}
    assert got == {"cup": 3, "jug": 8, "vat": None, "pan": None}


def test_auto_id(spark):
    df = docs(spark, "id int, remarks array<struct<note:string,id:string>>",
              {"id": 40, "remarks": [{"note": "late", "id": "r7"}, {"note": "torn page"}, {"note": "late"}]})
    rows = child_rows_at(df, F.col("remarks"), "c").select(
        fn.auto_id(F.col("id"), "remarks", F.col("pos"), F.col("c.id")).alias("k"), "c.note")
    assert [tuple(r) for r in rows.collect()] == [
        ("40.remarks.r7", "late"), ("40.remarks.[1]", "torn page"), ("40.remarks.[2]", "late")]


LINES = "id int, lang string, lines array<struct<text:string,lang:string>>"
SPEC = ExportSpec("lines", "form", (
    ColumnSpec("id", ("id",)), ColumnSpec("text", ("text",)), ColumnSpec("of", ("$", "lang")),
    ColumnSpec("lang", ("lang",))), root=("lines", "[*]"), value_or_root=True)


def exported(spark, schema, *rows, spec=SPEC):
    return [tuple(r) for r in export(DocTable(docs(spark, schema, *rows), "form"), spec).collect()]


def test_rows_from_lines_or_else_the_document(spark):
    """A document without lines is one row; its own members are then reached by ``$`` only."""
    assert exported(spark, LINES,
        {"id": 7, "lang": "de", "lines": [{"text": "eins", "lang": "nl"}, {"text": "zwei"}, {}]},
        {"id": 8, "lang": "fr", "lines": []}, {"id": 9, "lines": None}, {"id": None, "lang": "es"},
    ) == [("7.lines.[0]", "eins", "de", "nl"), ("7.lines.[1]", "zwei", "de", None), ("7.lines.[2]", None, "de", None),
          ("8", None, "fr", None), ("9", None, None, None), (None, None, "es", None)]


def test_one_line_that_is_no_list(spark):
    schema = LINES.replace("array<struct<text:string,lang:string>>", "struct<text:string,lang:string>")
    assert exported(spark, schema, {"id": 3, "lang": "it", "lines": {"text": "solo"}}, {"id": 4, "lang": "it", "lines": {}}) == [
        ("3.lines.[0]", "solo", "it", None), ("4", None, "it", None)]


def test_without_value_or_root_documents_without_lines_give_no_rows(spark):
    from dataclasses import replace
    rows = exported(spark, LINES, {"id": 5, "lines": []}, {"id": 6, "lines": [{"text": "a"}]}, {"id": 7},
                    spec=replace(SPEC, value_or_root=False))
    assert rows == [("6.lines.[0]", "a", None, None)]


def test_row_counts_of_unnesting(spark, sf):
    from docsheaf.catalog.base import documents
    df = documents(spark, sf)
    sizes = df.agg(F.sum(F.size("remarks")).alias("n"), F.count_if(F.size("remarks") == 0).alias("z")).first()
    assert child_rows(df, F.col("remarks")).count() == sizes["n"]
    outer = child_or_root_rows(df, F.col("remarks"))
    assert outer.count() == sizes["n"] + sizes["z"]
    assert outer.where(is_root_row()).count() == sizes["z"]


def test_typed_documents(spark):
    from docsheaf.sources import typed_documents, variant_schema
    rows = ['{"@id":"x","n":1,"xs":[{"y":1}],"mixed":1,"none":null}', '{"@id":"y","xs":[{"z":"t"}],"mixed":"a","o":{"#text":"q"}}']
    df = spark.createDataFrame([(r,) for r in rows], "j string").select(F.parse_json("j").alias("doc"))
    typed = typed_documents(df)
    assert dict(typed.dtypes)["xs"] == "array<struct<y:bigint,z:string>>"
    assert dict(typed.dtypes)["mixed"] == "variant" and dict(typed.dtypes)["none"] == "string"
    got = typed.select("`@id`", "n", "o.`#text`", fn.descendants(typed.schema, "z").alias("z")).collect()
    assert [tuple(r) for r in got] == [("x", 1, None, []), ("y", None, "q", ["t"])]
    assert typed_documents(df, schema=variant_schema(df)).schema == typed.schema
