"""Whole incremental runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docsheaf.plans import ColumnSpec, ExportSpec, Ledger, Run, export, run_export
from docsheaf.session import fresh_dir
from docsheaf.sinks import StoredTable, write_jdbc
from docsheaf.sources import DocTable

SPEC = ExportSpec("visits", "form", (
    ColumnSpec("id", ("id",)), ColumnSpec("name", ("name",)), ColumnSpec("count", ("count",))))
RUN = Run("q", SPEC.fingerprint(), ("visits",), "form", project="p", server="s")
SCHEMA = "id string, indexed_on string, name string, count int"


def day(n):
    return f"2024-01-{n:02d}T00:00:00Z"


def source(spark, rows, schema=SCHEMA):
    return DocTable(spark.createDataFrame(rows, schema), "form")


def test_incremental_runs(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    table = StoredTable(spark, f"{folder}/visits")
    rows = [("a", day(1), "A", 1), ("b", day(2), "B", 2)]
    first = run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    assert (first.since, first.until, first.mode) == (None, day(2), "date_indexed")
    # b again on the boundary, a changed twice: the last value per column counts.
    rows = [("old", day(1), "never read", 0), ("b", day(2), "B", 2), ("a", day(3), "A2", None), ("a", day(4), None, 9)]
    second = run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    assert (second.since, second.until) == (day(2), day(4))
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", "A2", 9), ("b", "B", 2)]
    assert ledger.rows().where("final").count() == 2
    again = run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    assert again.since == day(4) and table.read().count() == 2
    # Bounds of the caller's own leave the ledger alone.
    own = run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger, since=day(1), until=day(1))
    assert own.since == day(1) and table.read().count() == 3
    assert ledger.resume(RUN)["since_param"] == day(4)
    assert run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger, start_over=True).since is None


def test_documents_without_a_date_are_exported(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    rows = [("a", None, "A", 1), ("b", day(2), "B", 2), ("c", None, "C", 3)]
    done = run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    assert done.until == day(2) and StoredTable(spark, f"{folder}/visits").read().count() == 3
    assert (ledger.resume(RUN)["since_param"], ledger.resume(RUN)["last_doc_id"]) == (day(2), "b")
    undated = fresh_dir(spark, "run")
    done = run_export(source(spark, [r for r in rows if r[1] is None]), [SPEC], undated, RUN, ["indexed_on"],
                      Ledger(spark, fresh_dir(spark, "ledger")))
    assert done.until is None and StoredTable(spark, f"{undated}/visits").read().count() == 2


def test_order_keeps_its_type_beside_a_missing_value(spark):
    from dataclasses import replace
    folder = fresh_dir(spark, "run")
    rows = [("a", 9, "old", 1), ("a", 10, "new", 1)]
    docs = source(spark, rows, "id string, version int, name string, count int")
    run_export(docs, [replace(SPEC, missing_value="-")], folder, RUN, ["version"])
    assert StoredTable(spark, f"{folder}/visits").read().first()["name"] == "new"


def test_an_exclusive_upper_bound(spark):
    folder = fresh_dir(spark, "run")
    docs = source(spark, [("a", day(1), "A", 1), ("b", day(2), "B", 2)], SCHEMA.replace("indexed_on", "date_last_activity"))
    run_export(docs, [SPEC], folder, RUN, ["date_last_activity"], until=day(2))
    assert [r["id"] for r in StoredTable(spark, f"{folder}/visits").read().collect()] == ["a"]


def test_types_change_between_runs(spark):
    folder = fresh_dir(spark, "run")
    run_export(source(spark, [("a", day(1), "A", 10)]), [SPEC], folder, RUN, ["indexed_on"])
    texts = source(spark, [("b", day(2), "B", "abc")], SCHEMA.replace("count int", "count string"))
    run_export(texts, [SPEC], folder, RUN, ["indexed_on"])
    rows = StoredTable(spark, f"{folder}/visits").read().collect()
    assert sorted((r["id"], r["count"]) for r in rows) == [("a", "10"), ("b", "abc")]


def test_nothing_new(spark):
    ledger = Ledger(spark, fresh_dir(spark, "ledger"))
    done = run_export(source(spark, []), [SPEC], fresh_dir(spark, "run"), RUN, ["indexed_on"], ledger)
    assert done.until is None and ledger.rows().count() == 0


def test_cursor_source(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    spec = ExportSpec("rows", "ucr", (ColumnSpec("id", ("id",)), ColumnSpec("n", ("n",))))
    run = Run("q", spec.fingerprint(), ("rows",), "ucr")
    def docs(n):
        return DocTable(spark.range(n).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n")), "ucr")
    assert run_export(docs(5), [spec], folder, run, ["n"], ledger).mode == "cursor"
    done = run_export(docs(9), [spec], folder, run, ["n"], ledger)
    assert (done.since, done.until) == (4, 8)
    assert StoredTable(spark, f"{folder}/rows").read().count() == 9


def test_fallback_dates(spark):
    folder = fresh_dir(spark, "run")
    rows = [("a", dt.datetime(2024, 1, 1), None, 1), ("b", None, dt.datetime(2024, 1, 5), 2), ("c", None, dt.datetime(2024, 2, 1), 3)]
    docs = source(spark, rows, "id string, modified timestamp_ntz, received timestamp_ntz, count int")
    done = run_export(docs, [SPEC], folder, RUN, ["modified", "received"], until=dt.datetime(2024, 1, 31))
    assert done.until == dt.datetime(2024, 1, 31)
    assert sorted(r["id"] for r in StoredTable(spark, f"{folder}/visits").read().collect()) == ["a", "b"]


def variants(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("doc"))
    return DocTable(df, "form", variant="doc")


def test_documents_without_a_schema(spark):
    doc = variants(spark, '{"id":"well-12","depth":{"metres":40.5,"lined":false,"rock":null},"readings":[{"ph":7},{"ph":8},{"salt":2}],'
                          '"pump":{"ph":6},"repairs":[],"note":{"#text":"deep","@by":"ada"}}')
    columns = {
        "metres": (("depth", "metres"), {}), "lined": (("depth", "lined"), {}), "rock": (("depth", "rock"), {}), "owner": (("depth", "owner"), {}),
        "ph": (("readings", "[*]", "ph"), {}), "pump": (("pump", "[*]", "ph"), {}), "repairs": (("repairs",), {}), "note": (("note",), {}),
        "typed": (("readings", "[1]", "ph"), {"data_type": "integer"}), "either": (("lost",), {"alternates": (("pump", "ph"),)}),
        "shown": (("pump", "ph"), {"format_via": ("template", "pH {}")}),
    }
    spec = ExportSpec("wells", "form", tuple(ColumnSpec(n, path, **more) for n, (path, more) in columns.items()), missing_value="n/a")
    assert export(doc, spec).first().asDict() == {
        "metres": "40.5", "lined": "false", "rock": None, "owner": "n/a", "ph": "7,8", "pump": "6", "repairs": "n/a", "note": "deep",
        "typed": 8, "either": "6", "shown": "pH 6"}


def test_rows_from_documents_without_a_schema(spark):
    doc = variants(
        spark, '{"id":1,"foo":"r","bar":[{"baz":"a1"},{"baz":"a2","id":"k"}]}', '{"id":2,"foo":"r","bar":{"baz":"b"}}',
        '{"id":3,"foo":"r","bar":{}}', '{"id":4,"foo":"r","bar":[]}', '{"id":5,"foo":"r","bar":null}', '{"id":6,"foo":"r"}')
    spec = ExportSpec("t", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("baz", ("baz",)), ColumnSpec("root", ("$", "foo")), ColumnSpec("foo", ("foo",))),
        root=("bar", "[*]"), value_or_root=True)
    rows = sorted(tuple(r) for r in export(doc, spec).collect())
    assert rows == [("1.bar.[0]", "a1", "r", None), ("1.bar.k", "a2", "r", None), ("2.bar.[0]", "b", "r", None)] + [
        (str(i), None, "r", None) for i in (3, 4, 5, 6)]


def test_jdbc_needs_a_driver(spark):
    """No database is started here; only the hand-over to Spark's writer is checked."""
    with pytest.raises(Exception, match="(?i)driver"):
        write_jdbc(spark.range(1), "jdbc:none:x", "t")


def test_json_columns_are_merged(spark):
    folder = fresh_dir(spark, "run")
    spec = ExportSpec("docs", "form", (ColumnSpec("id", ("id",)), ColumnSpec("body", ("body",), data_type="json")))
    run = Run("q", spec.fingerprint(), ("docs",), "form")
    def go(*rows):
        run_export(source(spark, rows, "id string, indexed_on string, body string"), [spec], folder, run, ["indexed_on"])
    go(("a", day(1), '{"k":1}'), ("a", day(2), '{"k":2}'), ("b", day(2), None))
    go(("b", day(3), '{"k":3}'), ("a", day(3), None))
    rows = StoredTable(spark, f"{folder}/docs").read().select("id", F.try_variant_get("body", "$.k", "int").alias("k"))
    assert sorted(tuple(r) for r in rows.collect()) == [("a", 2), ("b", 3)]


def test_undated_documents_that_come_or_change_later(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    table = StoredTable(spark, f"{folder}/visits")

    def go(*rows):
        run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
        return {r["id"]: (r["name"], r["count"]) for r in table.read().collect()}

    dated = ("b", day(2), "B", 2)
    assert go(("a", None, "A", 1), ("c", None, "C", None), dated) == {"a": ("A", 1), "b": ("B", 2), "c": ("C", None)}
    # One comes, one changes, one moves its value to another column, one stays.
    changed = go(("a", None, "A2", 1), ("c", None, None, 7), ("d", None, "D", 4), dated)
    assert changed == {"a": ("A2", 1), "b": ("B", 2), "c": ("C", 7), "d": ("D", 4)}
    # Back to what it was before the last run, and twice in one run.
    assert go(("a", None, "A", 1), ("a", None, "A", 1), ("d", None, "D", 4), dated)["a"] == ("A", 1)
    log = spark.read.parquet(f"{folder}/undated/*")
    assert sorted((r["id"], r["number"]) for r in log.collect()) == [("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2), ("d", 2)]


def test_unchanged_undated_documents_are_not_merged_again(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    table = StoredTable(spark, f"{folder}/visits")
    rows = [("a", None, "A", 1), ("b", day(2), "B", 2)]
    run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    table.merge(spark.createDataFrame([("a", "by hand", 1)], "id string, name string, count int"))
    run_export(source(spark, rows), [SPEC], folder, RUN, ["indexed_on"], ledger)
    assert {r["id"]: r["name"] for r in table.read().collect()} == {"a": "by hand", "b": "B"}


def test_undated_documents_without_a_schema(spark):
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    spec = ExportSpec("visits", "form", (ColumnSpec("id", ("id",)), ColumnSpec("n", ("m", "n"))))
    run = Run("q", spec.fingerprint(), ("visits",), "form")
    for n in (1, 2):
        docs = variants(spark, '{"id":"b","at":"2024-01-02","m":{"n":0}}', '{"id":"a","m":{"n":%d}}' % n, '{"id":"c","at":null,"m":{"n":%d}}' % n)
        run_export(docs, [spec], folder, run, ["at"], ledger)
    rows = StoredTable(spark, f"{folder}/visits").read().collect()
    assert sorted((r["id"], r["n"]) for r in rows) == [("a", "2"), ("b", "0"), ("c", "2")]


def test_a_column_without_values_is_not_created(spark):
    folder = fresh_dir(spark, "run")
    spec = ExportSpec("visits", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("name", ("name",)), ColumnSpec("count", ("count",)), ColumnSpec("told", ("absent",), data_type="date")))
    table = StoredTable(spark, f"{folder}/visits")
    run_export(source(spark, [("a", day(1), None, 1)]), [spec], folder, RUN, ["indexed_on"])
    assert table.read().dtypes == [("id", "string"), ("count", "int"), ("told", "date")]
    run_export(source(spark, [("b", day(2), "B", None)]), [spec], folder, RUN, ["indexed_on"])
    assert sorted(map(tuple, table.read().select("id", "name", "count").collect())) == [("a", None, 1), ("b", "B", None)]
