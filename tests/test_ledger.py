"""The progress ledger."""

import pytest
from docsheaf.plans import Ledger, Run
from docsheaf.plans import ledger as L
from docsheaf.session import fresh_dir

RUN = Run("q", "md5", ("t1", "t2"), "form", project="p", server="s")


def ledger_of(spark, *rows):
    names = [f.split()[0] for f in L.SCHEMA.split(", ")]
    base = dict(spec_name="q", spec_md5="md5", project="p", server="s", final=True, pagination_mode="date_indexed", data_source="form")
    data = [tuple({**base, "id": str(i), **r}.get(n) for n in names) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, L.SCHEMA)


@pytest.fixture
def ledger(spark):
    return Ledger(spark, fresh_dir(spark, "ledger"))


def test_progress_and_clean_up(ledger):
    assert ledger.resume(RUN) is None
    ledger.record(RUN, "2020-01-01", "date_indexed", last_doc_id="d1", time_of_run="2021-01-01T00:00:00")
    ledger.record(RUN, "2020-02-01", "date_indexed", time_of_run="2021-01-01T00:01:00")
    assert ledger.rows().count() == 4
    assert ledger.resume(RUN)["since_param"] == "2020-02-01"
    ledger.record(RUN, "2020-03-01", "date_indexed", final=True, time_of_run="2021-01-01T00:02:00")
    rows = ledger.rows().collect()
    assert sorted(r["table_name"] for r in rows) == ["t1", "t2"] and all(r["final"] for r in rows)
    assert ledger.resume(RUN)["since_param"] == "2020-03-01"
    with pytest.raises(ValueError):
        ledger.record(RUN, "", "date_indexed")
    with pytest.raises(ValueError):
        ledger.record(Run("q", "md5", (), "form"), "2020-01-01", "date_indexed")


def test_resume_from_the_oldest_of_the_newest(spark):
    rows = ledger_of(
        spark, dict(table_name="t1", since_param="1", time_of_run="2021-01"), dict(table_name="t1", since_param="3", time_of_run="2021-03"),
        dict(table_name="t2", since_param="2", time_of_run="2021-02"), dict(table_name="t9", since_param="0", time_of_run="2020-01"))
    assert L.resume_row(rows, RUN).first()["since_param"] == "2"
    assert L.resume_row(rows, Run("q", "other", ("t1",), "form", "p", "s")).first() is None
    assert L.resume_row(rows, Run("q", "md5", ("t1",), "form", "p2", "s")).first() is None


def test_resume_by_key(spark):
    rows = ledger_of(
        spark, dict(table_name="t1", since_param="k", key="K", spec_md5="old", time_of_run="2021-05"),
        dict(table_name="t1", since_param="n", time_of_run="2021-06"))
    keyed = Run("q", "md5", ("t1",), "form", "p", "s", key="K")
    assert L.resume_row(rows, keyed).first()["since_param"] == "k"
    assert L.resume_row(rows, RUN).first()["since_param"] == "n"


def test_legacy_rows(spark, ledger):
    bare = dict(project=None, server=None, since_param="old", time_of_run="2022-01", pagination_mode=None)
    rows = ledger_of(spark, dict(since_param="mid", time_of_run="2021-01", pagination_mode=None), bare)
    assert L.resume_row(rows, RUN).first()["since_param"] == "mid"
    ledger.store.replace(ledger_of(spark, bare))
    row = ledger.resume(RUN)
    assert row["priority"] == 0 and row["since_param"] == "old" and row["pagination_mode"] == "date_modified"
    assert ledger.rows().count() == 3


def test_latest_three_ways(spark):
    rows = ledger_of(spark, *[dict(table_name=f"t{i % 3}", since_param=str(i), time_of_run=f"2021-01-{i:02d}") for i in range(1, 20)],
                     dict(table_name=None, since_param="x", time_of_run="2022-01-01"))
    named = rows.where("table_name is not null")
    want = {(r["table_name"], r["since_param"]) for r in L.newest(named, L.GROUP).collect()}
    assert want == {("t0", "18"), ("t1", "19"), ("t2", "17")}
    assert {(r["table_name"], r["since_param"]) for r in L.newest_by_rank(named, L.GROUP).collect()} == want
    assert {(r["table_name"], r["since_param"]) for r in L.newest_by_join(rows).collect()} == want
    plan = L.newest_by_rank(named, L.GROUP)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "each task cuts its groups before the shuffle"
    assert L.earliest_of_latest(named).first()["since_param"] == "17"


def test_history(spark):
    rows = ledger_of(spark, *[dict(table_name="t", time_of_run=f"2021-01-{i:02d}", key="K" if i % 2 else None) for i in range(1, 29)])
    assert [r["time_of_run"][-2:] for r in L.history(rows, 3).collect()] == ["28", "27", "26"]
    assert L.history(rows).count() == 20 and L.history(rows, key="K").count() == 14


def test_key_assignment(spark, ledger):
    ledger.store.replace(ledger_of(
        spark, dict(table_name="t1", time_of_run="1"), dict(table_name="t1", time_of_run="2"), dict(table_name="t2", time_of_run="1"),
        dict(table_name="t1", time_of_run="9", spec_md5="other")))
    ledger.assign_key("nightly", spec_md5="md5")
    assert sorted(r["id"] for r in ledger.rows().where("key = 'nightly'").collect()) == ["1", "2"]
    assert ledger.rows().count() == 4


def test_start_and_mode(spark):
    row = ledger_of(spark, dict(since_param="2020", cursor="c9", pagination_mode=None)).first()
    cursor_run = Run("q", "md5", ("t",), "ucr")
    assert L.start_point(row, RUN, start_over=True) is None
    assert L.start_point(row, RUN, since="2019") == "2019"
    assert L.start_point(row, RUN) == "2020" and L.start_point(row, cursor_run) == "c9" and L.start_point(None, RUN) is None
    assert L.scan_mode(row, RUN) == "date_modified"
    assert L.scan_mode(None, RUN) == "date_indexed" and L.scan_mode(None, cursor_run) == "cursor"
    assert L.scan_mode(row, RUN, start_over=True) == "date_indexed"
    assert L.ledger_used(None, None) and not L.ledger_used("2020", None) and not L.ledger_used(None, "2020")


def test_changed_spec(spark):
    rows = ledger_of(spark, dict(), dict(spec_md5="x"), dict(spec_name="y"), dict(spec_name=None))
    assert [r[0] for r in rows.select(L.spec_changed(None, RUN)).collect()] == [False, True, True, True]
