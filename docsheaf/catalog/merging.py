"""Queries over merging, column types, contracts and the file sinks."""

from pyspark.sql import functions as F

from ..functions import to_integer, to_number
from ..operators import (
    align, append, collapse, contract_report, declared_columns, infer_columns, rejects,
    type_evidence, upsert, width_profile, without_empty_columns,
)
from ..session import fresh_dir
from ..plans import ColumnSpec, ExportSpec, Ledger, Run
from ..sinks import StoredTable, read_csv, write_csv, write_json
from ..sources.pages import stream_pages, write_pages
from ..sources.tables import load
from ..streaming import merge_stream, stream_specs
from .base import query
from .sources import EVENT_DOC, PAGE

BATCH_SQL = """
base AS (
  SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders
), batch AS (
  SELECT l_orderkey + 100 AS id, CASE WHEN bool_or(l_returnflag = 'R') THEN 'R' END AS status,
         CASE WHEN count(*) > 3 THEN '9-BIG' END AS priority, count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey + 100)"""


def base_and_batch(spark, d):
    base = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))
    batch = load(spark, d, "lineitem").groupBy((F.col("l_orderkey") + 100).alias("id")).agg(
        F.when(F.bool_or(F.col("l_returnflag") == "R"), "R").alias("status"),
        F.when(F.count(F.lit(1)) > 3, "9-BIG").alias("priority"), F.count(F.lit(1)).alias("n_lines"))
    return base, batch


MERGED = """
SELECT coalesce(t.id, b.id) AS id, customer, coalesce(b.status, t.status) AS status,
       coalesce(b.priority, t.priority) AS priority, n_lines
FROM base t FULL OUTER JOIN batch b ON t.id = b.id"""


@query("merge_upsert", f"WITH {BATCH_SQL} {MERGED}")
def _(spark, d):
    return upsert(*base_and_batch(spark, d), "id")


@query("stored_merge", f"WITH {BATCH_SQL} {MERGED}")
def _(spark, d):
    base, batch = base_and_batch(spark, d)
    table = StoredTable(spark, fresh_dir(spark, "table"), "id", parts=4)
    table.merge(base)
    table.merge(batch)
    return table.read().select("id", "customer", "status", "priority", "n_lines")


@query("merge_collapse", """
SELECT user_id, arg_max(event_type, ts) FILTER (event_type <> 'view') AS event_type,
       arg_max(value, ts) FILTER (value > 10) AS value, max(ts) AS ts FROM events GROUP BY user_id""")
def _(spark, d):
    batch = load(spark, d, "events").select(
        "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 10, F.col("value")).alias("value"), "ts")
    return collapse(batch, "user_id", F.col("ts"))


@query("add_column", """
SELECT o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS BIGINT) AS size FROM orders
UNION ALL SELECT -1 - p_partkey, NULL, p_size FROM part""")
def _(spark, d):
    held = load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    new = load(spark, d, "part").select((-1 - F.col("p_partkey")).alias("id"), F.col("p_size").cast("bigint").alias("size"))
    return append(list(align(held, new)))


@query("widen_type", """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS a, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS b,
       CAST(o_orderdate AS DATE) AS c, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS e FROM orders
UNION ALL
SELECT -1 - event_id, event_type, props, CAST(ts AS DATE), strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM events""")
def _(spark, d):
    held = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("a"), (F.col("o_orderstatus") == "F").alias("b"),
        F.col("o_orderdate").cast("date").alias("c"), F.col("o_orderdate").alias("e"))
    iso = F.concat(F.substring(F.col("ts").cast("string"), 1, 10), F.lit("T"),
                   F.substring(F.col("ts").cast("string"), 12, 8), F.lit("Z"))
    new = load(spark, d, "events").select(
        (-1 - F.col("event_id")).alias("id"), F.col("event_type").alias("a"), F.col("props").alias("b"),
        F.col("ts").alias("c"), iso.alias("e"))
    return append(list(align(held, new)))


@query("strict_type", """
SELECT o_orderkey AS id, o_custkey AS a FROM orders
UNION ALL SELECT -1 - c_custkey, c_nationkey FROM customer""")
def _(spark, d):
    held = load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("a"))
    new = load(spark, d, "customer").select(
        (-1 - F.col("c_custkey")).alias("id"), F.col("c_nationkey").cast("string").alias("a"))
    return append(list(align(held, new, strict=True)))


@query("declared_types", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day, o_custkey AS customer,
       CAST(o_totalprice AS BIGINT) AS price, o_orderpriority AS priority FROM (
  SELECT o_orderkey, o_orderdate, o_custkey, trunc(o_totalprice) AS o_totalprice, o_orderpriority FROM orders)""")
def _(spark, d):
    docs = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("day"),
        F.col("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"))
    return declared_columns(docs, {"id": "text", "day": "date", "customer": "integer", "price": "integer"})


@query("reject_rows", """
SELECT o_orderkey AS id, 'amount' AS "column", o_orderpriority AS value FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'count', o_orderstatus FROM orders""")
def _(spark, d):
    docs = load(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string")).alias("amount"), F.col("o_orderstatus").alias("count"))
    return rejects(docs, "o_orderkey", {
        "amount": to_number(F.col("amount")), "count": to_integer(F.col("count"))})


TEXTS = ("event_id", "ts", "value", "event_type", "positive")


def event_texts(spark, d):
    return load(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("string").alias("ts"),
        F.col("value").cast("string").alias("value"), "event_type",
        (F.col("value") > 0).cast("string").alias("positive"), F.lit(None).cast("string").alias("nothing"))


@query("infer_types", """
SELECT event_id, ts, value, event_type, value > 0 AS positive, '00' || event_id AS padded, '+49' || event_id AS phone,
       strftime(ts, '%Y-%m-%d %H:%M:%S') || '+02:00' AS zoned, '12345678901234567890' || event_id AS long_number,
       event_id || '.10' AS version, (1 + event_id % 9) || 'e5' AS power, 9007199254740993 + event_id AS huge,
       CASE WHEN event_id % 2 = 0 THEN '9007199254740993' ELSE '0.5' END AS unequal FROM events""")
def _(spark, d):
    """Texts that a number or a time would not give back stay texts."""
    key = F.col("event_id").cast("string")
    return infer_columns(event_texts(spark, d).withColumns({
        "padded": F.concat(F.lit("00"), key), "phone": F.concat(F.lit("+49"), key),
        "zoned": F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")),
        "long_number": F.concat(F.lit("12345678901234567890"), key),
        "version": F.concat(key, F.lit(".10")), "power": F.concat((1 + F.col("event_id").cast("bigint") % 9).cast("string"), F.lit("e5")),
        "huge": (F.lit(9007199254740993) + F.col("event_id").cast("bigint")).cast("string"),
        "unequal": F.when(F.col("event_id").cast("bigint") % 2 == 0, "9007199254740993").otherwise("0.5")}), drop_empty=True)


@query("empty_columns", "SELECT event_id, event_type FROM events")
def _(spark, d):
    events = load(spark, d, "events").select(
        "event_id", F.lit(None).cast("double").alias("nothing"), "event_type")
    return without_empty_columns(events)


@query("type_evidence", """
SELECT count(*) AS n, count(TRY_CAST(props AS BIGINT)) AS whole,
       count(*) FILTER (regexp_matches(event_type, '^[0-9]+$')) AS digits FROM events""")
def _(spark, d):
    seen = type_evidence(load(spark, d, "events"), ["props", "event_type"])
    return seen.select(F.col("`props|n`").alias("n"), F.col("`props|bigint`").alias("whole"),
                       F.col("`event_type|bigint`").alias("digits"))


@query("append_union", """
SELECT o_orderkey AS id, o_orderstatus AS status FROM orders
UNION ALL SELECT l_orderkey, l_linestatus FROM lineitem""")
def _(spark, d):
    return append([
        load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")),
        load(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("status")),
    ])


@query("contract_report", """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_keys,
       count(*) FILTER (c > 1) AS repeated_keys, CAST(0 AS BIGINT) AS long_names, true AS reserved
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)""")
def _(spark, d):
    return contract_report(load(spark, d, "lineitem"), "l_orderkey", "org_users")


@query("width_profile", """
SELECT CAST(max(length(CAST(c_custkey AS VARCHAR))) AS INTEGER) AS c_custkey,
       CAST(max(length(c_name)) AS INTEGER) AS c_name,
       CAST(max(length(c_mktsegment)) AS INTEGER) AS c_mktsegment FROM customer""")
def _(spark, d):
    return width_profile(load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("csv_roundtrip", """
SELECT o_orderkey, o_orderdate, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS status FROM orders""")
def _(spark, d):
    folder = fresh_dir(spark, "csv")
    orders = load(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("status"))
    write_csv(orders, folder)
    schema = "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, status string"
    return read_csv(spark, folder, schema)


@query("json_roundtrip", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS BIGINT) AS user_id, event_type
FROM events""")
def _(spark, d):
    folder = fresh_dir(spark, "json")
    write_json(load(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), folder)
    return spark.read.schema("event_id bigint, ts string, user_id bigint, event_type string").json(folder)


@query("stream_merge", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, d):
    """Two overlapping landings of all events, merged as a stream into a stored table."""
    folder, state = fresh_dir(spark, "landing"), fresh_dir(spark, "stream")
    events = load(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    write_pages(events, f"{folder}/a", PAGE)
    write_pages(events, f"{folder}/b", PAGE)
    table = StoredTable(spark, fresh_dir(spark, "table"), "event_id", parts=2)
    stream = stream_pages(spark, f"{folder}/*", EVENT_DOC, files_per_batch=1000)
    running = merge_stream(stream, table, "ts", state)
    running.awaitTermination()
    return table.read()


@query("stream_specs", """
WITH last AS (SELECT CAST(event_id AS VARCHAR) AS id, ts FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1)
SELECT 'events' AS tbl, CAST(event_id AS VARCHAR) AS id, event_type AS kind, ts AS changed_on FROM events
UNION ALL SELECT 'purchases', CAST(event_id AS VARCHAR), 'u' || user_id, ts FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'ledger', id, unnest(['events', 'purchases']), ts FROM last""")
def _(spark, d):
    """Two overlapping landings of all events, exported to two tables as a stream, and how far the ledger says they got."""
    landing, folder = fresh_dir(spark, "landing"), fresh_dir(spark, "specs")
    events = load(spark, d, "events").select(
        "event_id", "ts", F.concat(F.lit("u"), "user_id").alias("user"), "event_type")
    write_pages(events.where(F.col("event_id") % 3 != 0), f"{landing}/a", PAGE)
    write_pages(events.where(F.col("event_id") % 3 != 1), f"{landing}/b", PAGE)
    specs = [
        ExportSpec("events", "form", (ColumnSpec("id", ("event_id",), data_type="text"), ColumnSpec("kind", ("event_type",)))),
        ExportSpec("purchases", "form", (ColumnSpec("id", ("event_id",), data_type="text"), ColumnSpec("kind", ("user",))),
                   filters=(("event_type", "purchase"),)),
    ]
    run = Run("stream", "m", ("events", "purchases"), "form", key="stream")
    ledger = Ledger(spark, fresh_dir(spark, "ledger"))
    stream = stream_pages(spark, f"{landing}/*", "struct<event_id:bigint,ts:timestamp_ntz,user:string,event_type:string>", files_per_batch=1000)
    stream_specs(stream, "form", specs, folder, run, "ts", ledger, fresh_dir(spark, "stream"), "event_id", parts=2).awaitTermination()
    parts = [StoredTable(spark, f"{folder}/{s.table}", "id", 2).read().select(F.lit(s.table).alias("tbl"), "id", "kind", "changed_on") for s in specs]
    reached = ledger.rows().where("final").select(
        F.lit("ledger").alias("tbl"), F.col("last_doc_id").alias("id"), F.col("table_name").alias("kind"),
        F.col("since_param").cast("timestamp_ntz").alias("changed_on"))
    latest = reached.groupBy("tbl", "kind").agg(F.max(F.struct("changed_on", "id")).alias("m")).select("tbl", "m.id", "kind", "m.changed_on")
    return parts[0].unionByName(parts[1]).unionByName(latest)
