"""A stream of documents into several tables."""

import datetime as dt

from docsheaf.plans import ColumnSpec, ExportSpec, Ledger, Run
from docsheaf.session import fresh_dir
from docsheaf.sinks import StoredTable
from docsheaf.sources import DocTable
from docsheaf.sources.pages import stream_pages, write_pages
from docsheaf.streaming import export_batch, stream_specs
from docsheaf.streaming.spec_stream import batch_done

SCHEMA = "id string, at timestamp_ntz, name string, tags array<struct<t:string>>"
SPECS = [
    ExportSpec("people", "form", (ColumnSpec("id", ("id",)), ColumnSpec("name", ("name",)))),
    ExportSpec("tags", "form", (ColumnSpec("id", ("id",)), ColumnSpec("t", ("t",))), root=("tags",)),
]
RUN = Run("s", "m", ("people", "tags"), "form", key="s")


def day(n):
    return dt.datetime(2024, 1, n)


def tables(spark, folder):
    return [sorted(tuple(r)[:2] for r in StoredTable(spark, f"{folder}/{s.table}").read().collect()) for s in SPECS]


def test_a_replayed_batch_is_recognised(spark):
    folder, ledger = fresh_dir(spark, "specs"), Ledger(spark, fresh_dir(spark, "ledger"))
    docs = lambda *rows: DocTable(spark.createDataFrame(rows, SCHEMA), "form")
    go = lambda number, *rows: export_batch(docs(*rows), number, SPECS, folder, RUN, "at", ledger)
    assert batch_done(ledger, RUN) == -1
    assert go(0, ("a", day(1), "A", [("x",)]), ("b", day(2), "B", None))
    assert go(1, ("a", day(3), "A2", [("x",), ("y",)]))
    want = [("a", "A2"), ("b", "B")], [("a.tags.[0]", "x"), ("a.tags.[1]", "y")]
    assert tuple(tables(spark, folder)) == want and batch_done(ledger, RUN) == 1
    rows = ledger.rows().count()
    # The checkpoint gives batch 1 again, with whatever the source says by now.
    assert not go(1, ("a", day(9), "never", None)) and not go(0, ("a", day(9), "never", None))
    assert tuple(tables(spark, folder)) == want and ledger.rows().count() == rows
    # Late rows fill nulls only, and the ledger does not go back.
    assert go(2, ("a", day(2), "late", None), ("c", day(1), "C", None))
    assert tables(spark, folder)[0] == [("a", "A2"), ("b", "B"), ("c", "C")]
    assert ledger.resume(RUN)["since_param"] == day(3).isoformat() and ledger.resume(RUN)["last_doc_id"] == "a" and batch_done(ledger, RUN) == 2


def test_a_stream_that_dies_between_two_tables(spark, monkeypatch):
    folder, ledger, checkpoint, landing = (fresh_dir(spark, "specs"), Ledger(spark, fresh_dir(spark, "ledger")),
                                           fresh_dir(spark, "cp"), fresh_dir(spark, "landing"))
    rows = spark.createDataFrame([(str(i), day(1 + i % 5), f"n{i}", [(f"t{i}",)]) for i in range(12)], SCHEMA)
    write_pages(rows, f"{landing}/1", 5)

    def run():
        stream = stream_pages(spark, f"{landing}/*", "struct<" + SCHEMA.replace("id string", "id:string").replace("at timestamp", "at:timestamp")
                              .replace("name string", "name:string").replace("tags array", "tags:array") + ">")
        query = stream_specs(stream, "form", SPECS, folder, RUN, "at", ledger, checkpoint)
        query.awaitTermination()

    plain, calls = StoredTable.merge, []

    def dying(table, *args, **named):
        calls.append(table.path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(table, *args, **named)

    monkeypatch.setattr(StoredTable, "merge", dying)
    try:
        run()
        raise AssertionError("the first run should have died")
    except Exception as error:
        assert "lost" in str(error)
    assert batch_done(ledger, RUN) == -1
    run()
    assert [len(t) for t in tables(spark, folder)] == [12, 12] and batch_done(ledger, RUN) == 0
    run()  # nothing new has landed
    assert [len(t) for t in tables(spark, folder)] == [12, 12] and batch_done(ledger, RUN) == 0
