"""Values of the function library, one literal at a time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsheaf import functions as fn

LIST = T.ArrayType(T.StringType())


def lit(v):
    return F.lit(v)


def cases():
    NULL = F.lit(None).cast("string")
    return [
        (fn.multiply(lit(2), lit(3)), 6),
        (fn.add(lit("a"), lit("b"), T.StringType()), "ab"),
        (fn.floor_divide(lit(-7), lit(2)), -4),
        (fn.divide(lit(7), lit(2)), 3.5),
        (fn.divide(lit(7), lit(0), lenient=True), None),
        (lit(56) > lit(23.5), True),
        (fn.length_of(F.array(lit(1), lit(2), lit(3)), LIST), 3),
        (fn.length_of(lit("日本"), T.StringType()), 2),
        (fn.is_truthy(lit("a"), T.StringType()), True),
        (fn.is_truthy(lit(""), T.StringType()), False),
        (fn.is_truthy(NULL, T.StringType()), False),
        (fn.is_truthy(lit(0), T.IntegerType()), False),
        (fn.is_truthy(lit(0.5), T.DoubleType()), True),
        (fn.is_truthy(F.array(), LIST), False),
        (fn.is_empty(F.array(), LIST), True),
        (fn.is_empty(lit(""), T.StringType()), False),
        (fn.to_bool(lit("true")), True),
        (fn.to_bool(lit("T")), True),
        (fn.to_bool(lit("1")), True),
        (fn.to_bool(lit(1)), True),
        (fn.to_bool(lit("0")), False),
        (fn.to_bool(lit("日本")), False),
        (fn.to_bool(NULL), False),
        (fn.to_bool(lit(True)), True),
        (fn.bool_to_int(lit("t")), 1),
        (fn.bool_to_int(NULL), 0),
        (fn.to_number(lit("10")), 10.0),
        (fn.to_number(lit(" 10.56 ")), 10.56),
        (fn.to_number(lit("")), None),
        (fn.to_number(lit("abc")), None),
        (fn.to_number(lit("1d")), None),
        (fn.to_number(lit("-inf")), float("-inf")),
        (fn.to_integer(lit("10")), 10),
        (fn.to_integer(lit("10.9")), None),
        (fn.to_datetime(lit("2015-01-01")), dt.datetime(2015, 1, 1)),
        (fn.to_datetime(lit("2015-01-01T18:32:57")), dt.datetime(2015, 1, 1, 18, 32, 57)),
        (fn.to_datetime(lit("2015-01-01T18:32:57.001200")), dt.datetime(2015, 1, 1, 18, 32, 57)),
        (fn.to_datetime(lit("2015-01-01T18:32:57.001200Z")), dt.datetime(2015, 1, 1, 18, 32, 57)),
        (fn.to_datetime(lit("2015-01-01T18:32:57.0012+02:30")), dt.datetime(2015, 1, 1, 16, 2, 57)),
        (fn.to_datetime(lit("2015-01-01 18:32:57 -0800")), dt.datetime(2015, 1, 2, 2, 32, 57)),
        (fn.to_datetime(lit("1969-12-31T23:59:58.5Z")), dt.datetime(1969, 12, 31, 23, 59, 58)),
        (fn.to_datetime(lit("日")), None),
        (fn.to_datetime(lit("")), None),
        (fn.to_datetime(lit("1 Jan 2015"), "d MMM yyyy"), dt.datetime(2015, 1, 1)),
        (fn.to_datetime(lit("31/12/2015 02:30"), "dd/MM/yyyy HH:mm"), dt.datetime(2015, 12, 31, 2, 30)),
        (fn.format_uuid(lit("f00")), None),
        (fn.format_uuid(lit("00a3e0194ce1458794c50971dee2de22")), "00a3e019-4ce1-4587-94c5-0971dee2de22"),
        (fn.format_uuid(lit("00A3E019-4ce1-4587-94c5-0971dee2de22")), "00a3e019-4ce1-4587-94c5-0971dee2de22"),
        (fn.format_uuid(NULL), None),
        (fn.sha1_text(lit("a bb 日本")), "e25a54025417b06d88d40baa8c71f6eee9c07fb1"),
        (fn.sha1_text(lit(2015)), "9cdda67ded3f25811728276cefa76b80913b4c54"),
        (fn.sha1_text(NULL), None),
        (fn.to_json_text(lit("x"), T.StringType()), "x"),
        (fn.to_json_text(F.struct(lit(1).alias("a")), T.StructType()), '{"a":1}'),
        (fn.selected_at(lit("a b c"), "1"), "b"),
        (fn.selected_at(lit("a b 日"), "-1"), "日"),
        (fn.selected_at(lit("a b c"), 5), None),
        (fn.selected_at(lit("a b c"), -4), None),
        (fn.selected_at(lit(""), 0), None),
        (fn.selected_at(lit("a b c"), "x"), "Error: index must be an integer"),
        (fn.selected_at(lit("a b c"), lit("2")), "c"),
        (fn.selected_at(lit("a b c"), lit("x")), "Error: index must be an integer"),
        (fn.selected_at(lit("a\t b c\x1dd"), 3), "d"),
        (fn.selected(lit("a b c"), "b"), True),
        (fn.selected(lit("a bb 日本"), "b"), False),
        (fn.selected(lit("a bb 日本"), "日本"), True),
        (fn.selected(lit(""), "b"), None),
        (fn.count_selected(lit("a bb 日本")), 3),
        (fn.count_selected(lit("  ")), 0),
        (fn.count_selected(lit("")), None),
        (fn.join_text(".", lit("a"), lit("b"), lit("c")), "a.b.c"),
        (fn.join_text(".", lit("a"), NULL, lit(3)), "a.3"),
        (fn.default_value(NULL, "a", T.StringType()), "a"),
        (fn.default_value(lit(""), "a", T.StringType()), "a"),
        (fn.default_value(lit("b"), "a", T.StringType()), "b"),
        (fn.first_present(NULL, lit("2")), "2"),
        (fn.first_present(lit(""), lit("x")), ""),
        (fn.first_present(lit(0), lit(1)), 0),
        (fn.first_present(F.array().cast("array<int>"), F.array(lit(1), lit(2)), dtype=LIST), [1, 2]),
        (fn.template("{}.{}", lit("1"), lit("2")), "1.2"),
        (fn.template("no places"), "no places"),
        (fn.template("{}", NULL), None),
        (fn.distinct_items(F.array(lit(1), lit(2), lit(3), lit(2)), LIST), [1, 2, 3]),
        (fn.distinct_items(lit("a"), T.StringType()), "a"),
        (fn.doc_url("form", "https://h", lit("d1"), lit("123")), "https://h/a/d1/reports/form_data/123/"),
        (fn.doc_url("case", "https://h", lit("d1"), lit("123")), "https://h/a/d1/reports/case_data/123/"),
        (fn.attachment_url("https://h", lit("d1"), lit("123"), lit("a.jpg")), "https://h/a/d1/api/form/attachment/123/a.jpg"),
        (fn.attachment_url("https://h", lit("d1"), lit("123"), lit("")), None),
        (fn.attachment_urls("h", lit("d"), lit("1"), F.array(lit("a"), lit("b"))),
         ["h/a/d/api/form/attachment/1/a", "h/a/d/api/form/attachment/1/b"]),
        (fn.unwrap_single(F.array(lit(42))), 42),
        (fn.unwrap_single(F.array(lit(1), lit(2))), None),
        (fn.items_where(F.array(*[lit(i) for i in (1, 2, 3, 4)]), lambda n: n > 2), [3, 4]),
        (fn.cell_text(F.array().cast("array<string>"), LIST, "---"), "---"),
        (fn.cell_text(F.array(lit("a")), LIST, "---"), "a"),
        (fn.cell_text(F.array(lit(1), lit(2)), T.ArrayType(T.IntegerType())), "1,2"),
        (fn.cell_text(F.array(F.array(lit(1), lit(2)), F.array(lit(3))), T.ArrayType(T.ArrayType(T.IntegerType()))), "1,2,3"),
        (fn.cell_text(lit(3), T.IntegerType()), 3),
        (fn.cell_text(NULL, T.StringType(), "---"), "---"),
    ]


def test_values(spark):
    listed = cases()
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(listed)]).first()
    wrong = [(str(c), got, want) for (c, want), got in zip(listed, row) if got != want or type(got) is not type(want)]
    assert not wrong


ALPHABET = "abcdefghijklmnopqrstuvwxyz"
GREEK = "αβγδεζηθικλμνξοπρςστυφχψω"


@pytest.mark.parametrize("text,start,end,expected", [
    (ALPHABET, -4, 30, None), (ALPHABET, 0, 26, ALPHABET), (ALPHABET, 10, 16, "klmnop"),
    (ALPHABET, 13, 14, "n"), (ALPHABET, 13, 13, ""), (ALPHABET, 14, 13, ""), (ALPHABET, 5, -1, None),
    (GREEK, 0, 25, GREEK), (GREEK, 10, 15, "λμνξο"), (GREEK, 13, 12, ""),
    (123456, 0, 6, "123456"), (123456, 2, 4, "34"), (123456, -1, 3, None), ("", 0, 3, None),
])
def test_substr(value, text, start, end, expected):
    assert value(fn.substr_range(F.lit(text), start, end)) == expected


def test_dates_do_not_depend_on_the_session_zone(spark, value):
    """02:30 on this day does not exist in New York."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = dt.datetime(2024, 3, 10, 2, 30)
        assert value(fn.to_datetime(F.lit("2024-03-10T02:30:00"))) == gap
        assert value(fn.to_datetime(F.lit("2024-03-10T02:30:00Z"))) == gap
        assert value(fn.to_datetime(F.lit("10/03/2024 02:30"), "dd/MM/yyyy HH:mm")) == gap
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_template_needs_enough_values():
    with pytest.raises(IndexError):
        fn.template("{} {}", F.lit("a"))


@pytest.mark.parametrize("call,expected", [
    (("selected-at", 3), "d"),
    (("selected-at", "x"), "Error: selected-at index must be an integer: selected-at(x)"),
    (("selected", "b"), True),
    (("selected", "Other_(Specify)"), False),
    (("template", "my name is {}"), "my name is a b c d"),
    (("template",), "Error: template function requires the format template: template()"),
    (("substr", 2, 5), "b c"),
    (("substr", -2, 5), "Error: both substr arguments must be non-negative integers: substr(-2, 5)"),
    (("substr", "a", 5), "Error: both substr arguments must be non-negative integers: substr(a, 5)"),
    (("count-selected",), 4),
])
def test_via(value, call, expected):
    assert value(fn.via(*call)(F.lit("a b c d"))) == expected


def test_registry(value):
    fn.register("twice", lambda v: v + v)
    fn.register_row_function("plus_one", lambda s: s + 1, "bigint")
    assert value(fn.call("twice", F.lit(2))) == 4
    assert value(fn.call("plus_one", F.lit(2).cast("bigint"))) == 3
    with pytest.raises(ValueError):
        fn.register("twice", lambda v: v)
    with pytest.raises(KeyError):
        fn.call("absent")


@pytest.mark.parametrize("document,expected", [
    ('"hi"', "hi"),
    ('{"#text":"test_text","@case_type":"person","@relationship":"child","id":"nothing"}', "test_text"),
    ('{"@case_type":"","@relationship":"child","id":"some_id"}', ""),
    ('{"t":123}', '{"t":123}'),
    ("5", "5"),
    ("[1,2]", "[1,2]"),
])
def test_xml_variant(value, document, expected):
    assert value(fn.xml_text(F.parse_json(F.lit(document)), T.VariantType())) == expected


def test_xml_struct(spark, value):
    def cell(schema, row):
        df = spark.createDataFrame([(row,)], f"c struct<{schema}>")
        return value(fn.xml_text(F.col("c"), df.schema["c"].dataType), df)
    assert cell("`#text`:string,`@a`:string", ("t", "x")) == "t"
    assert cell("`#text`:string,`@a`:string", (None, "x")) == ""
    assert cell("`@a`:string,id:string", ("x", "i")) == ""
    assert cell("t:int", (123,)) == '{"t":123}'
    assert cell("`@a`:string", None) is None


def test_lists_of_objects_are_joined_as_json(spark):
    df = spark.createDataFrame([([(1, "a"), (2, None)],)], "v array<struct<n:int,t:string>>")
    assert df.select(fn.cell_text(F.col("v"), df.schema["v"].dataType)).first()[0] == '{"n":1,"t":"a"},{"n":2}'


def test_numbers_of_two_kinds(spark):
    texts = ["9007199254740993", "-9223372036854775808", "9223372036854775808", "12345678901234567890123456789012345678", "007", " +5 ", "1.5", "1e3", "1d", "x", "", None, "1" * 39]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", fn.to_exact_number(F.col("t")).alias("v"))
    got = [r[0] for r in df.orderBy("i").select(F.to_json("v")).collect()]
    assert got[:8] == ["9007199254740993", "-9223372036854775808", "9223372036854775808", "12345678901234567890123456789012345678", "7", "5", "1.5", "1000.0"]
    assert got[8:12] == [None] * 4 and float(got[12]) == float("1" * 39)


def test_declared_whole_numbers_keep_their_digits(spark):
    from docsheaf.plans import ColumnSpec, ExportSpec, export
    from docsheaf.sources import DocTable
    docs = DocTable(spark.createDataFrame([("9007199254740993",), ("2.5",), ("many",)], "id string"), "form")
    spec = ExportSpec("t", "form", (
        ColumnSpec("whole", ("id",), map_via=("str2num",), data_type="integer"), ColumnSpec("shown", ("id",), map_via=("str2num",), format_via=("template", "<{}>")),
        ColumnSpec("either", ("id",), map_via=("str2num",))))
    out = export(docs, spec)
    assert dict(out.dtypes) == {"whole": "bigint", "shown": "string", "either": "double"}
    assert [(r["whole"], r["shown"]) for r in out.collect()] == [(9007199254740993, "<9007199254740993>"), (None, "<2.5>"), (None, None)]
