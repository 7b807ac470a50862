"""Export specs: cells, alternates, mappings, contracts and shared sources."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docsheaf.operators import ContractError, check_names, contract_report, width_profile
from docsheaf.plans import ColumnSpec, ExportSpec, export, export_many, with_actor
from docsheaf.session import fresh_dir
from docsheaf.sources import DocTable, inline_rows
from test_paths import docs


def table(df, resource="form"):
    return DocTable(df, resource)


def test_missing_value(spark):
    """Stands for absent members and nulls, in columns of text only."""
    df = docs(spark, "page struct<size:int,final:boolean,title:string>", {"page": {"size": 12, "final": False}}, {})
    spec = ExportSpec("pages", "form", (
        ColumnSpec("size", ("page", "size"), data_type="integer"), ColumnSpec("final", ("page", "final")),
        ColumnSpec("title", ("page", "title")), ColumnSpec("author", ("page", "author"))), missing_value="n/a")
    assert [tuple(r) for r in export(table(df), spec).collect()] == [(12, "false", "n/a", "n/a"), (None, "n/a", "n/a", "n/a")]


@pytest.mark.parametrize("step,cells", [
    (("json2str",), ["a b", "7", '["p"]', '["p","q"]', '{"k":"v"}']),
    (("default", "none"), ["a b", "7", '["p"]', '["p","q"]', '{"k":"v"}']),
    (("selected-at", 0), ["a", "7", "p", "p,q", '{"k":"v"}']),
    (("substr", 0, 1), ["a", "7", "p", "p", "{"]),
    (("template", "<{:>4}>"), ["< a b>", "<   7>", "<   p>", "< p,q>", '<{"k":"v"}>']),
    (("bool",), [True] * 5),
    (("len",), [3, 1, 1, 2, None]),
    (("unique",), ["a b", 7, "p", "p,q", '{"k":"v"}']),
])
def test_steps_on_values_of_every_type(spark, step, cells):
    """Text, number, list of one, longer list, object: a list of one counts as its element for single values."""
    df = docs(spark, "t string, n int, one array<string>, xs array<string>, o struct<k:string>",
              {"t": "a b", "n": 7, "one": ["p"], "xs": ["p", "q"], "o": {"k": "v"}})
    for name, want in zip(("t", "n", "one", "xs", "o"), cells):
        if want is not None:
            spec = ExportSpec("t", "form", (ColumnSpec("v", (name,), map_via=step),))
            assert export(table(df), spec).first()["v"] == want, name


def test_mappings_never_multiply_rows(spark):
    df = docs(spark, "id int, xs array<string>", {"id": 1, "xs": ["a"]}, {"id": 2, "xs": ["a", "b"]}, {"id": 3})
    mapping = spark.createDataFrame([("m", "a", "first", 1), ("m", "a", "last", 2), ("m", "a", "other", 0)],
                                    "name string, source string, destination string, position int")
    spec = ExportSpec("t", "form", (ColumnSpec("v", ("xs",), mapping="m"),))
    assert [r["v"] for r in export(table(df), spec, mapping).collect()] == ["last", "a,b", None]


def test_list_cells_are_joined(spark):
    df = docs(spark, "id int, xs array<struct<y:int>>", {"id": 1, "xs": [{"y": 1}, {"y": 2}]}, {"id": 2, "xs": []})
    spec = ExportSpec("t", "form", (ColumnSpec("ys", ("xs", "[*]", "y")),), missing_value="-")
    assert [r[0] for r in export(table(df), spec).collect()] == ["1,2", "-"]


def test_nested_lists_are_flattened_along_a_path(spark):
    df = docs(spark, "xs array<struct<ys:array<struct<z:int>>>>", {"xs": [{"ys": [{"z": 1}, {"z": 2}]}, {"ys": [{"z": 3}]}]})
    spec = ExportSpec("t", "form", (ColumnSpec("zs", ("xs", "ys", "z")),))
    assert export(table(df), spec).first()[0] == "1,2,3"
    gaps = docs(spark, "xs array<struct<ys:array<struct<z:int>>>>",
                {"xs": [{"ys": [{"z": 1}, {}, None]}, {}, None, {"ys": [{"z": 3}]}]}, {"xs": [{}, {"ys": [{}]}]}, {})
    filled = replace(spec, missing_value="-")
    assert [r[0] for r in export(table(gaps), filled).collect()] == ["1,3", "-", "-"]
    rows = ExportSpec("t", "form", (ColumnSpec("z", ("z",)),), root=("xs", "[*]", "ys"))
    assert [r[0] for r in export(table(gaps), rows).collect() if r[0]] == [1, 3]
    fallback = ExportSpec("t", "form", (ColumnSpec("z", ("xs", "ys", "z"), alternates=(("xs", "ys", "z"),)),), missing_value="-")
    assert [r[0] for r in export(table(gaps), fallback).collect()] == ["1,3", "-", "-"]


def test_the_whole_row(spark):
    df = docs(spark, "id int, xs array<string>", {"id": 1, "xs": ["a", "b"]})
    spec = ExportSpec("t", "form", (ColumnSpec("x", ("`this`",)), ColumnSpec("parent", ("$", "id"))), root=("xs",))
    assert [tuple(r) for r in export(table(df), spec).collect()] == [("a", 1), ("b", 1)]
    whole = ExportSpec("t", "form", (ColumnSpec("doc", ("`this`",)),))
    assert export(table(df), whole).first()[0] == '{"id":1,"xs":["a","b"]}'


def test_order_of_the_steps(spark):
    """Alternates, then map via, then format via, then the mapping."""
    df = docs(spark, "id int, a string, b string", {"id": 1, "b": "x y z"}, {"id": 2, "a": "p q"}, {"id": 3, "a": ""})
    mapping = inline_rows(spark, [("names", "<y>", "mapped"), ("names", "<q>", "")], "name string, source string, destination string")
    spec = ExportSpec("t", "form", (
        ColumnSpec("v", ("a",), alternates=(("b",),), map_via=("selected-at", 1), format_via=("template", "<{}>"), mapping="names"),))
    assert [r[0] for r in export(table(df), spec, mapping).collect()] == ["mapped", "<q>", None]
    with pytest.raises(ValueError):
        export(table(df), spec)


def test_addresses_and_templates_with_paths(spark):
    df = docs(spark, "id int, domain string, repeat array<struct<photo:string>>, q string",
              {"id": 123, "domain": "d1", "repeat": [{"photo": "a.jpg"}, {"photo": "b.jpg"}], "q": "Ann"})
    spec = ExportSpec("t", "form", (
        ColumnSpec("form", ("id",), format_via=("form_url",)), ColumnSpec("case", ("id",), map_via=("case_url",)),
        ColumnSpec("photos", ("repeat", "[*]", "photo"), map_via=("attachment_url",)),
        ColumnSpec("name", ("q",), map_via=("template", "my name is {}")),
        ColumnSpec("both", ("q",), map_via=("template", "{}/{}", ("$", "domain"), ("q",)))), base_url="https://h")
    doc = table(df)
    assert tuple(export(doc, spec).first()) == (
        "https://h/a/d1/reports/form_data/123/", "https://h/a/d1/reports/case_data/123/",
        "https://h/a/d1/api/form/attachment/123/a.jpg,https://h/a/d1/api/form/attachment/123/b.jpg",
        "my name is Ann", "d1/Ann")
    per_photo = ExportSpec("t", "form", (ColumnSpec("url", ("photo",), map_via=("attachment_url",)),),
                           root=("repeat", "[*]"), base_url="h")
    assert [r[0] for r in export(doc, per_photo).collect()] == [
        "h/a/d1/api/form/attachment/123/a.jpg", "h/a/d1/api/form/attachment/123/b.jpg"]
    got = {}
    export_many(doc, [replace(spec, table="a", columns=spec.columns[:1] + (ColumnSpec("id", ("id",)),)),
                      replace(per_photo, table="b", columns=per_photo.columns + (ColumnSpec("id", ("id",)),))],
                lambda name, out: got.update({name: out.count()}))
    assert got == {"a": 1, "b": 2}


def test_declared_types(spark):
    df = docs(spark, "id int, d string, n string, j string, u int", {"id": 1, "d": "2020-01-02", "n": "x", "j": '{"a":1}', "u": 5})
    spec = ExportSpec("t", "form", (
        ColumnSpec("id", ("id",), data_type="text"), ColumnSpec("d", ("d",), data_type="date"),
        ColumnSpec("n", ("n",), data_type="integer"), ColumnSpec("j", ("j",), data_type="json"),
        ColumnSpec("u", ("u",), data_type="no-such-type")))
    with pytest.warns(UserWarning, match="no-such-type"):
        out = export(table(df), spec)
    assert [t for _, t in out.dtypes] == ["string", "date", "bigint", "variant", "string"]
    row = out.select("id", "n", F.try_variant_get("j", "$.a", "int").alias("a"), "u").first()
    assert tuple(row) == ("1", None, 1, "5")


def test_actor_column():
    spec = ExportSpec("t", "form", (ColumnSpec("id", ("id",)),))
    added = with_actor(spec)
    assert added.columns[-1] == ColumnSpec("actor_id", ("$", "metadata", "userID"))
    assert with_actor(added) == added
    assert with_actor(replace(spec, resource="location")).columns == spec.columns
    with pytest.raises(ValueError):
        with_actor(replace(spec, columns=(ColumnSpec("actor_id", ("other",)),)))


def test_spec_round_trip_and_fingerprint():
    spec = ExportSpec("t", "form", (ColumnSpec("v", ("a", "b"), alternates=(("c",),), map_via=("substr", 0, 3)),),
                      root=("xs",), filters=(("type", "x"),))
    again = ExportSpec.from_json(spec.to_json())
    assert again == spec
    assert again.fingerprint() == spec.fingerprint()
    assert replace(spec, table="u").fingerprint() != spec.fingerprint()


def test_unknown_resource(spark):
    with pytest.raises(ValueError, match="unknown resource"):
        DocTable(spark.range(1), "letters")
    with pytest.raises(ValueError, match="reads form"):
        export(DocTable(spark.range(1), "case"), ExportSpec("t", "form", ()))


@pytest.mark.parametrize("keep", [True, False])
def test_many_tables_from_one_source(spark, keep):
    df = docs(spark, "id int, foo struct<a:int>, actions array<struct<a:int>>, unused string",
              {"id": 1, "foo": {"a": 7}, "actions": [{"a": 1}, {"a": 2}], "unused": "x"})
    specs = [
        ExportSpec("t1", "form", (ColumnSpec("id", ("id",)), ColumnSpec("a", ("foo", "a")))),
        ExportSpec("t2", "form", (ColumnSpec("id", ("id",)), ColumnSpec("a", ("a",)), ColumnSpec("p", ("$", "foo", "a"))), root=("actions", "[*]")),
    ]
    folder, got = fresh_dir(spark, "many"), {}
    def write(name, out):
        out.write.parquet(f"{folder}/{name}")
        got[name] = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/{name}").collect())
    export_many(table(df), specs, write, keep=keep)
    assert got == {"t1": [(1, 7)], "t2": [("1.actions.[0]", 1, 7), ("1.actions.[1]", 2, 7)]}
    with pytest.raises(ContractError):
        export_many(table(df), [replace(specs[0], table="org_users")], write)


def test_only_named_fields_are_read(spark, sf):
    from docsheaf.sources import load
    orders = load(spark, sf, "orders").withColumnRenamed("o_orderkey", "id")
    spec = ExportSpec("t", "case", (ColumnSpec("id", ("id",)), ColumnSpec("s", ("o_orderstatus",))),
                      filters=(("o_orderpriority", "1-URGENT"),))
    plan = export(DocTable(orders, "case"), spec)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_names():
    check_names("t", ["id", "x" * 63], "postgres")
    with pytest.raises(ContractError, match="63"):
        check_names("t", ["id", "x" * 64], "postgres")
    check_names("t", ["id", "x" * 128], "mssql")
    with pytest.raises(ContractError, match="required"):
        check_names("t", ["x"])
    with pytest.raises(ContractError, match="reserved"):
        check_names("org_locations", ["id"])
    with pytest.raises(ContractError, match="unknown target"):
        check_names("t", ["id"], "abacus")


def test_contract_and_widths(spark):
    df = spark.createDataFrame([("a", "xx"), ("a", "日本語"), (None, None), ("b", "")], "id string, text string")
    seen = {"n_rows": 4, "null_keys": 1, "repeated_keys": 1, "long_names": 0, "reserved": False}
    assert contract_report(df).first().asDict() == seen
    wide = df.withColumnRenamed("text", "x" * 64)
    assert contract_report(wide, table="org_users").first()["long_names"] == 1
    assert contract_report(wide, target="mysql", table="org_users").first()["long_names"] == 0
    assert contract_report(df.where("false"), table="org_users").first().asDict() == {
        "n_rows": 0, "null_keys": 0, "repeated_keys": 0, "long_names": 0, "reserved": True}
    assert width_profile(df).first().asDict() == {"id": 1, "text": 3}
