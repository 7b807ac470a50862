"""Types, merging, stored tables and the stream."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsheaf.operators import (
    append, choose_types, collapse, declared_columns, fits, infer_columns, rejects, upsert,
    without_empty_columns,
)
from docsheaf.session import fresh_dir
from docsheaf.sinks import StoredTable, read_csv, write_csv, write_json
from docsheaf.sources.pages import stream_pages, write_pages
from docsheaf.streaming import merge_stream

FANCY = "id string, a int, b string, c boolean, d date, e timestamp_ntz"


def by_id(df):
    return {r["id"]: tuple(r)[1:] for r in df.collect()}


def test_lattice():
    text, whole, flag = T.StringType(), T.LongType(), T.BooleanType()
    time, day, doc = T.TimestampNTZType(), T.DateType(), T.VariantType()
    assert fits(whole, text) and fits(flag, whole) and fits(time, day) and fits(day, text) and fits(doc, doc)
    assert fits(whole, T.DoubleType()) and not fits(T.DoubleType(), whole)
    assert not fits(text, whole) and not fits(whole, flag) and not fits(day, time) and not fits(doc, text)


def test_type_change(spark):
    held = spark.createDataFrame([("bazzle", 4, "日本", False, dt.date(2015, 1, 2), dt.datetime(2014, 5, 1, 11, 16, 45))], FANCY)
    new = spark.createDataFrame(
        [("bizzle", "yo dude", "本", "true", dt.datetime(2015, 2, 13), "2014-08-01T11:23:45:00.0000Z")],
        "id string, a string, b string, c string, d timestamp_ntz, e string")
    assert by_id(upsert(held, new, "id")) == {
        "bizzle": ("yo dude", "本", "true", dt.date(2015, 2, 13), "2014-08-01T11:23:45:00.0000Z"),
        "bazzle": ("4", "日本", "false", dt.date(2015, 1, 2), "2014-05-01 11:16:45"),
    }


def test_strict_types_fail_on_a_value_that_does_not_fit(spark):
    held = spark.createDataFrame([("a", 1)], "id string, n int")
    good = spark.createDataFrame([("b", "2")], "id string, n string")
    assert by_id(upsert(held, good, "id", strict=True)) == {"a": (1,), "b": (2,)}
    bad = spark.createDataFrame([("b", "x")], "id string, n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        upsert(held, bad, "id", strict=True).collect()


def test_nulls_never_overwrite(spark):
    schema = "id string, a string, b string, c string"
    held = spark.createDataFrame([("row1", "a1", "keep1", "x"), ("row2", "a2", "b2", "c2")], schema)
    new = spark.createDataFrame([("row1", "new", None, None), ("row3", "a3", None, "c3")], schema)
    assert by_id(upsert(held, new, "id")) == {
        "row1": ("new", "keep1", "x"), "row2": ("a2", "b2", "c2"), "row3": ("a3", None, "c3")}


def test_late_column(spark):
    held = spark.createDataFrame([(str(i), i) for i in range(10)], "id string, a int")
    new = spark.createDataFrame([(str(i), "v") for i in range(8, 13)], "id string, b string")
    merged = by_id(upsert(held, new, "id"))
    assert len(merged) == 13 and merged["0"] == (0, None) and merged["9"] == (9, "v") and merged["12"] == (None, "v")


def test_collapse_takes_the_last_value_per_column(spark):
    rows = [("x", 1, "a", None), ("x", 2, None, 5), ("x", 3, "c", None), ("y", 1, None, None)]
    df = spark.createDataFrame(rows, "id string, seq int, s string, n int")
    assert by_id(collapse(df, "id", F.col("seq"))) == {"x": (3, "c", 5), "y": (1, None, None)}


CELLS = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.none() | st.sampled_from("abc"),
                           st.none() | st.integers(0, 3)), max_size=12, unique_by=lambda r: r[:2])
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "id int, seq int, s string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@QUICK
@given(CELLS, CELLS)
def test_merging_twice_is_merging_once(spark, old, new):
    held = collapse(frame(spark, old), "id", F.col("seq"))
    batch = collapse(frame(spark, new), "id", F.col("seq"))
    once = upsert(held, batch, "id")
    assert by_id(upsert(once, batch, "id")) == by_id(once)


@QUICK
@given(CELLS)
def test_splitting_a_batch_by_time_changes_nothing(spark, rows):
    early = collapse(frame(spark, [r for r in rows if r[1] < 5]), "id", F.col("seq"))
    late = collapse(frame(spark, [r for r in rows if r[1] >= 5]), "id", F.col("seq"))
    whole = by_id(collapse(frame(spark, rows), "id", F.col("seq")))
    assert by_id(upsert(early, late, "id")) == whole


def test_an_older_version_only_fills_nulls(spark):
    held = spark.createDataFrame([(1, 9, "new", None)], SCHEMA)
    late = spark.createDataFrame([(1, 3, "old", 7)], SCHEMA)
    assert by_id(upsert(held, late, "id", time="seq")) == {1: (9, "new", 7)}


def test_rows_without_a_key_are_refused(spark):
    held = spark.createDataFrame([(1, 1, "a", 1)], SCHEMA)
    bad = spark.createDataFrame([(None, 1, "a", 1), (None, 2, "b", 1)], SCHEMA)
    with pytest.raises(Exception, match="without a key"):
        collapse(bad, "id", F.col("seq")).collect()
    with pytest.raises(Exception, match="without a key"):
        upsert(held, bad, "id").collect()


def test_append_needs_the_same_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    assert append([a, a]).count() == 2
    with pytest.raises(ValueError):
        append([a, a.withColumnRenamed("x", "y")])


def test_inference(spark):
    rows = [("1", "1.5", "true", "2020-01-01", "2020-01-01T10:00:00", "1", None, "5"),
            (" 2 ", "2", "False", "2020-02-01", "2020-01-01 10:00:00", "x", None, "2020-01-01")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string, h string")
    assert choose_types(df) == {"a": "bigint", "b": "double", "c": "boolean", "d": "date", "e": "timestamp_ntz",
                                "f": "string", "g": None, "h": "string"}
    out = infer_columns(df, drop_empty=True)
    assert out.columns == list("abcdefh") and out.first()["a"] == 1
    assert infer_columns(df, drop_empty=True, keep=["g"]).columns == list("abcdefgh")
    assert without_empty_columns(df).columns == list("abcdefh")
    assert choose_types(spark.createDataFrame([("0",), ("1",)], "x string")) == {"x": "bigint"}


@pytest.mark.parametrize("texts,kind", [
    (["1.10"], "string"), (["1e5"], "string"), (["007"], "string"), (["+1"], "string"), (["-0"], "string"), (["1."], "string"), ([".5"], "string"),
    (["1.5", "2", "-3.0"], "double"), (["0.1", "123456.789012345678"], "string"), (["12345.678901234567"], "double"), (["0.0001"], "double"),
    (["9007199254740992", "0.5"], "double"), (["9007199254740993", "0.5"], "string"), (["9007199254740993", "1"], "bigint"),
    (["9223372036854775807", "-9223372036854775808"], "bigint"), (["9223372036854775808"], "string"), (["123456789012345678901"], "string"),
    (["2024-02-30"], "string"), (["2024-02-29", None], "date"), (["2024-02-29", "2024-02-29 10:00"], "string"), (["1234-567890"], "string"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), ([""], "string"), ([None, None], None)])
def test_texts_keep_what_a_cast_would_lose(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert choose_types(df) == {"x": kind}


def test_declared_cast(spark):
    df = spark.createDataFrame([("1", 2, 3, '{"k":1}')], "a string, b int, c int, j string")
    out = declared_columns(df, {"a": "integer", "b": "text", "j": "json"})
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("c", "int"), ("j", "variant")]


def test_rejects(spark):
    df = spark.createDataFrame([("x", "1", "2020-01-01"), ("y", "abc", None), ("z", "q", "never")], "id string, n string, d string")
    out = rejects(df, "id", {"n": F.col("n").try_cast("int"), "d": F.col("d").try_cast("date")})
    assert sorted(tuple(r) for r in out.collect()) == [("y", "n", "abc"), ("z", "d", "never"), ("z", "n", "q")]


def test_stored_table(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=3)
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.merge(spark.createDataFrame([(str(i), i) for i in range(20)], "id string, n int"))
    table.merge(spark.createDataFrame([("3", None, "x")], "id string, n int, s string"))
    rows = by_id(table.read())
    assert len(rows) == 20 and rows["3"] == (3, "x") and rows["4"] == (4, None)
    table.merge(spark.createDataFrame([("99", "text")], "id string, n string"))
    rows = by_id(table.read())
    assert len(rows) == 21 and rows["7"] == ("7", None) and rows["99"] == ("text", None)
    table.replace(spark.createDataFrame([("only", "1")], "id string, n string"))
    assert by_id(table.read()) == {"only": ("1",)}
    table.replace(table.read().where("false"))
    assert table.exists() and table.read().count() == 0
    table.merge(spark.createDataFrame([("x", "1")], "id string, n string"))
    assert by_id(table.read()) == {"x": ("1",)}
    with pytest.raises(ValueError, match="parts"):
        StoredTable(spark, table.path, "id", parts=5).read()


def test_wider_numbers(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=4)
    table.merge(spark.createDataFrame([(str(i), i, 0.5, i) for i in range(8)], "id string, n int, f float, part int"))
    table.merge(spark.createDataFrame([("3", 2**40, 0.25, 9)], "id string, n bigint, f double, part short"))
    out = table.read()
    assert out.dtypes == [("id", "string"), ("n", "bigint"), ("f", "double"), ("part", "int")]
    assert by_id(out)["3"] == (2**40, 0.25, 9) and by_id(out)["7"] == (7, 0.5, 7) and out.count() == 8


def test_a_merge_that_dies_leaves_the_table_alone(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id")
    table.merge(spark.createDataFrame([("a", 1)], "id string, n int"))
    bad = spark.createDataFrame([("b", "x")], "id string, n string")
    with pytest.raises(Exception):
        table.merge(bad, strict=True)
    assert by_id(table.read()) == {"a": (1,)}


def test_csv(spark):
    folder = fresh_dir(spark, "csv")
    rows = [("a", None, dt.datetime(2020, 1, 2, 3, 4, 5, 600), True), ('q"u,o', "", None, False)]
    write_csv(spark.createDataFrame(rows, "id string, s string, t timestamp_ntz, b boolean"), folder)
    text = "\n".join(sorted(r[0] for r in spark.read.text(folder).collect()))
    assert "2020-01-02 03:04:05,true" in text and "a,," in text
    back = by_id(read_csv(spark, folder, "id string, s string, t timestamp_ntz, b boolean"))
    assert back["a"] == (None, dt.datetime(2020, 1, 2, 3, 4, 5), True) and back['q"u,o'][0] in ("", None)


def test_json(spark):
    folder = fresh_dir(spark, "json")
    df = spark.createDataFrame([("a", 1.5, dt.datetime(2020, 1, 2, 3, 4, 5), None, 7)], "id string, f double, t timestamp_ntz, n string, i int")
    write_json(df, folder)
    assert spark.read.text(folder).first()[0] == '{"id":"a","f":"1.5","t":"2020-01-02 03:04:05","n":null,"i":7}'


DOC = "struct<id:int,seq:int,s:string,n:int>"


@pytest.mark.parametrize("files", [1, 1000])
def test_stream_equals_batch_in_any_order(spark, files):
    """Pages overlap and arrive in an order of their own; versions are complete."""
    rows = [(i % 5, v, f"s{v}", v) for i in range(5) for v in range(4)]
    landing = fresh_dir(spark, "landing")
    df = frame(spark, rows)
    write_pages(df.repartition(3, "seq").sortWithinPartitions(F.desc("seq")), f"{landing}/1", 4)
    write_pages(df.where("seq < 3"), f"{landing}/2", 5)
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=2)
    seen = []
    stream = stream_pages(spark, f"{landing}/*", DOC, files_per_batch=files)
    merge_stream(stream, table, "seq", fresh_dir(spark, "cp"), after=lambda b, n: seen.append(n)).awaitTermination()
    assert by_id(table.read()) == by_id(collapse(df, "id", F.col("seq")))
    assert seen == list(range(len(seen))) and seen
    again = stream_pages(spark, f"{landing}/*", DOC)
    before = by_id(table.read())
    merge_stream(again, table, "seq", fresh_dir(spark, "cp2")).awaitTermination()
    assert by_id(table.read()) == before


def test_stream_with_bounded_state(spark):
    landing = fresh_dir(spark, "landing")
    base = dt.datetime(2024, 1, 1)
    schema = "id int, ts timestamp_ntz, v string"
    rows = spark.createDataFrame([(i, base + dt.timedelta(minutes=i), "x") for i in range(6)], schema)
    write_pages(rows, f"{landing}/1", 2)
    write_pages(rows, f"{landing}/2", 3)
    table = StoredTable(spark, fresh_dir(spark, "t"), "id")
    stream = stream_pages(spark, f"{landing}/*", "struct<id:int,ts:timestamp_ntz,v:string>")
    merge_stream(stream, table, "ts", fresh_dir(spark, "cp"), delay="1 hour").awaitTermination()
    assert table.read().count() == 6


def test_a_key_that_occurs_twice_fails(spark):
    table = StoredTable(spark, fresh_dir(spark, "twice"))
    table.merge(spark.createDataFrame([("a", 1)], "id string, n int"))
    with pytest.raises(Exception, match="share the id b"):
        table.merge(spark.createDataFrame([("b", 1), ("b", 2)], "id string, n int"))
    assert [tuple(r) for r in table.read().collect()] == [("a", 1)]


def files(spark, table):
    held = spark.read.parquet(table.path).select("table_part", F.input_file_name().alias("f")).distinct().collect()
    return {(r["table_part"], r["f"]) for r in held}


def test_only_parts_with_keys_of_the_batch_are_rewritten(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=64)
    table.merge(spark.range(800).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n")))
    before = files(spark, table)
    changed = spark.range(8).select((F.col("id") * 100).cast("string").alias("id"), F.lit(2).alias("n"))
    table.merge(changed)
    after = files(spark, table)
    touched = {r[0] for r in changed.select(table._part_of()).distinct().collect()}
    assert {p for p, _ in after - before} == touched and len(touched) <= 8
    assert {f for p, f in before if p not in touched} == {f for p, f in after if p not in touched}
    assert table.read().agg(F.sum("n"), F.count("*")).first()[:] == (808, 800)


def test_columns_are_born_with_their_first_value(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=4)
    late = ["a", "b"]
    table.merge(spark.createDataFrame([("x", None, None), ("y", None, None)], "id string, a string, b string"), optional=late)
    assert table.read().columns == ["id"]
    table.merge(spark.createDataFrame([("z", 5, None)], "id string, a int, b string"), optional=late)
    assert table.read().dtypes == [("id", "string"), ("a", "int")]
    table.merge(spark.createDataFrame([("x", None, dt.date(2024, 1, 1))], "id string, a int, b date"), optional=late)
    assert by_id(table.read()) == {"x": (None, dt.date(2024, 1, 1)), "y": (None, None), "z": (5, None)}
    assert dict(table.read().dtypes)["b"] == "date"


def test_a_merge_may_be_repeated(spark):
    table = StoredTable(spark, fresh_dir(spark, "t"), "id", parts=3)
    batch = spark.createDataFrame([(str(i), i) for i in range(9)], "id string, n int")
    for _ in range(3):
        table.merge(batch)
    assert table.read().count() == 9 and spark.read.parquet(table.path).count() == 9
