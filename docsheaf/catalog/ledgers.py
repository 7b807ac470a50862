"""Queries over a progress ledger, with events as its rows: type as table, ts as time."""

from pyspark.sql import functions as F

from ..plans import ColumnSpec, ExportSpec, Ledger, run_export
from ..plans import ledger as L
from ..session import fresh_dir
from ..sinks import StoredTable
from ..sources.tables import DocTable, load
from .base import query

RUN = L.Run("forms", "m1", ("click", "purchase"), "form", project="p1", server="s1")

# Rows of three ages: with a table, without one, and without a project.
LEDGER_SQL = """
ledger AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'forms' AS spec_name,
         CASE WHEN value > 50 THEN 'm2' ELSE 'm1' END AS spec_md5,
         CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE event_type END AS table_name,
         CASE WHEN event_type = 'error' THEN NULL ELSE 'p1' END AS project,
         CASE WHEN event_type = 'error' THEN NULL ELSE 's1' END AS server,
         CAST(user_id AS VARCHAR) AS since_param, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time_of_run,
         value > 20 AS final FROM events)"""


def rows(spark, d):
    kind = F.col("event_type")
    old = kind == "error"
    text = F.col("ts").cast("string")
    # Trailing zeros of the fraction are written out, so that times sort as text.
    padded = F.rpad(F.when(F.length(text) > 19, text).otherwise(F.concat(text, F.lit("."))), 26, "0")
    return load(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"), F.lit("forms").alias("spec_name"),
        F.when(F.col("value") > 50, "m2").otherwise("m1").alias("spec_md5"),
        F.when(~kind.isin("error", "view"), kind).alias("table_name"), F.lit(None).cast("string").alias("key"),
        F.when(~old, "p1").alias("project"), F.when(~old, "s1").alias("server"),
        F.col("user_id").cast("string").alias("since_param"), padded.alias("time_of_run"),
        (F.col("value") > 20).alias("final"),
    )


SHOWN = ["id", "spec_md5", "table_name", "project", "since_param", "time_of_run", "final"]
SHOW = "id, spec_md5, table_name, project, since_param, time_of_run, final"


@query("latest_per_table", f"""
WITH {LEDGER_SQL}
SELECT {SHOW} FROM ledger JOIN (
  SELECT project AS p, server AS s, spec_md5 AS m, table_name AS t, max(time_of_run) AS x
  FROM ledger WHERE table_name IS NOT NULL GROUP BY ALL)
ON project = p AND server = s AND spec_md5 = m AND table_name = t AND time_of_run = x ORDER BY table_name, spec_md5""")
def _(spark, d):
    return L.newest_by_join(rows(spark, d)).orderBy("table_name", "spec_md5").select(*SHOWN)


@query("latest_window", f"""
WITH {LEDGER_SQL}
SELECT {SHOW} FROM ledger QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY time_of_run DESC, id DESC) = 1""")
def _(spark, d):
    return L.newest_by_rank(rows(spark, d), ["table_name"]).select(*SHOWN)


@query("latest_grouped", f"""
WITH {LEDGER_SQL}
SELECT {SHOW} FROM ledger
QUALIFY row_number() OVER (PARTITION BY project, server, spec_md5, table_name ORDER BY time_of_run DESC, id DESC) = 1""")
def _(spark, d):
    return L.newest(rows(spark, d), L.GROUP).select(*SHOWN)


@query("earliest_of_latest", f"""
WITH {LEDGER_SQL}, latest AS (
  SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY time_of_run DESC, id DESC) = 1)
SELECT {SHOW} FROM latest ORDER BY time_of_run LIMIT 1""")
def _(spark, d):
    return L.earliest_of_latest(rows(spark, d)).select(*SHOWN)


@query("history_top", f"""
WITH {LEDGER_SQL}
SELECT {SHOW} FROM ledger WHERE project = 'p1' ORDER BY time_of_run DESC, id DESC LIMIT 20""")
def _(spark, d):
    return L.history(rows(spark, d), project="p1", server=None).select(*SHOWN)


@query("resume_point", f"""
WITH {LEDGER_SQL}, mine AS (
  SELECT *, 0 AS priority FROM ledger WHERE spec_md5 = 'm1' AND project = 'p1' AND server = 's1' AND table_name IN ('click', 'purchase')),
latest AS (SELECT * FROM mine QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY time_of_run DESC) = 1)
SELECT {SHOW}, priority FROM latest ORDER BY time_of_run LIMIT 1""")
def _(spark, d):
    return L.resume_row(rows(spark, d), RUN).select(*SHOWN, "priority")


@query("resume_legacy", f"""
WITH {LEDGER_SQL}, old AS (
  SELECT *, CASE WHEN project = 'p1' THEN 1 ELSE 2 END AS priority FROM ledger
  WHERE spec_md5 = 'm1' AND table_name IS NULL)
SELECT {SHOW}, priority FROM old ORDER BY priority, time_of_run DESC LIMIT 1""")
def _(spark, d):
    unseen = L.Run("forms", "m1", ("unseen",), "form", project="p1", server="s1")
    return L.resume_row(rows(spark, d), unseen).select(*SHOWN, "priority")


@query("ledger_cleanup", f"""
WITH {LEDGER_SQL}
SELECT {SHOW} FROM ledger WHERE NOT (NOT final AND spec_md5 = 'm1' AND coalesce(project = 'p1', false)
  AND coalesce(server = 's1', false) AND coalesce(table_name IN ('click', 'purchase'), false))""")
def _(spark, d):
    return L.without_unfinished(rows(spark, d), RUN).select(*SHOWN)


@query("ledger_set_key", f"""
WITH {LEDGER_SQL}, latest AS (
  SELECT id AS k FROM ledger WHERE table_name IS NOT NULL AND spec_md5 = 'm1'
  QUALIFY row_number() OVER (PARTITION BY project, server, spec_md5, table_name ORDER BY time_of_run DESC, id DESC) = 1)
SELECT {SHOW}, CASE WHEN k IS NOT NULL THEN 'nightly' END AS key FROM ledger LEFT JOIN latest ON id = k""")
def _(spark, d):
    return L.with_key(rows(spark, d), "nightly", spec_md5="m1").select(*SHOWN, "key")


@query("spec_changed", f"""
WITH {LEDGER_SQL} SELECT id, spec_md5 <> 'm1' AS changed FROM ledger""")
def _(spark, d):
    return rows(spark, d).select("id", L.spec_changed(None, RUN).alias("changed"))


@query("incremental_export", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 50 <> 7 THEN ts END AS ts, event_type, 'u' || user_id AS actor FROM events""")
def _(spark, d):
    """What had arrived by the middle of the month, then everything new, undated events that came or changed since included.

    Of the undated events a third arrives between the runs and a third changes.
    """
    docs = load(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"), F.when(F.col("event_id") % 50 != 7, F.col("ts")).alias("ts"), "event_type",
        F.concat(F.lit("u"), "user_id").alias("user"))
    spec = ExportSpec("events", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("ts", ("ts",), data_type="datetime"), ColumnSpec("event_type", ("event_type",)),
        ColumnSpec("actor", ("user",))))
    run = L.Run("events", spec.fingerprint(), ("events",), "form")
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    undated, third = F.col("ts").isNull(), F.col("id").cast("bigint") % 3
    early = docs.where((undated & (third != 0)) | (F.col("ts") <= F.lit("2024-01-15").cast("timestamp_ntz")))
    early = early.withColumn("event_type", F.when(undated & (third == 1), "draft").otherwise(F.col("event_type")))
    for source in (early, docs):
        run_export(DocTable(source, "form"), [spec], folder, run, ["ts"], ledger)
    return StoredTable(spark, f"{folder}/events").read()


@query("incremental_modes", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def _(spark, d):
    """A ledger from the legacy mode is continued along the fields of that mode, not the caller's default."""
    docs = load(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").alias("modified"),
        (F.col("ts") - F.expr("INTERVAL 1 YEAR")).alias("indexed"), "event_type")
    spec = ExportSpec("events", "form", (ColumnSpec("id", ("id",)), ColumnSpec("event_type", ("event_type",))), missing_value="-")
    run = L.Run("events", spec.fingerprint(), ("events",), "form")
    folder, ledger = fresh_dir(spark, "run"), Ledger(spark, fresh_dir(spark, "ledger"))
    ledger.record(run, "2024-01-15T00:00:00", L.LEGACY_MODE, final=True)
    run_export(DocTable(docs, "form"), [spec], folder, run, ["indexed"], ledger, mode_fields={L.LEGACY_MODE: ["modified"]})
    return StoredTable(spark, f"{folder}/events").read()


@query("incremental_variant", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events
WHERE event_type IN ('click', 'purchase') AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def _(spark, d):
    """Filters and a date range on documents without a schema, by the names of their members."""
    events = load(spark, d, "events")
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"), day.alias("at")))
    docs = events.select(F.parse_json(text).alias("doc"))
    spec = ExportSpec("events", "form", (ColumnSpec("id", ("id",)), ColumnSpec("kind", ("type",))),
                      filters=(("type", "click"), ("type", "purchase")))
    run = L.Run("events", spec.fingerprint(), ("events",), "form")
    folder = fresh_dir(spark, "run")
    run_export(DocTable(docs, "form", variant="doc"), [spec], folder, run, ["at"],
               since="2024-01-10T00:00:00.000000", until="2024-01-20T00:00:00.000000")
    return StoredTable(spark, f"{folder}/events").read()
