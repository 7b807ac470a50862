"""Queries over sources: scans, filters, ranges, pages and related documents."""

import datetime as dt

from pyspark.sql import functions as F

from ..session import fresh_dir
from ..sources import (
    in_range, inline_children, inline_rows, keyset_page, match_filters, next_cursor,
    one_per_id, progress_date, read_pages, read_pages_untyped, related_rows, since_until,
    since_until_fallback, write_pages,
)
from ..sources.tables import load
from ..functions import variant_field
from .base import query

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
EVENT_DOC = f"struct<{EVENT.replace(' ', ':').replace(',:', ',')}>"
PAGE = 1000


def landed(spark, d):
    """Events as JSON pages of a bounded size under the shared folder."""
    folder = fresh_dir(spark, "pages")
    events = load(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    write_pages(events, folder, PAGE)
    return folder


@query("read_pages", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, d):
    return read_pages(spark, landed(spark, d), EVENT_DOC)


@query("read_pages_untyped", "SELECT CAST(event_id AS BIGINT) AS event_id, event_type FROM events")
def _(spark, d):
    docs = read_pages_untyped(spark, landed(spark, d))
    return docs.select(
        variant_field(F.col("doc"), "event_id", as_type="bigint").alias("event_id"),
        variant_field(F.col("doc"), "event_type").alias("event_type"),
    )


@query("inline_rows", """
SELECT o_orderkey, o_orderstatus, s.label FROM orders
LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) s(code, label) ON o_orderstatus = s.code""")
def _(spark, d):
    labels = inline_rows(spark, [("F", "finished"), ("O", "open")], "code string, label string")
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    joined = orders.join(labels, orders.o_orderstatus == labels.code, "left")
    return joined.select("o_orderkey", "o_orderstatus", "label")


@query("filter_source_or", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'""")
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return match_filters(orders, [
        ("o_orderstatus", "F"), ("o_orderstatus", "P"), ("o_orderpriority", "1-URGENT"),
    ])


@query("range_since_until", """
SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
ORDER BY ts, event_id""")
def _(spark, d):
    events = load(spark, d, "events").select("event_id", "ts", "event_type")
    rows = since_until(events, "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12))
    return rows.orderBy("ts", "event_id")


@query("range_until_exclusive", """
SELECT o_orderkey, o_orderdate AS date_last_activity FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("date_last_activity"))
    return since_until(orders, "date_last_activity", dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1))


@query("range_open_since", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def _(spark, d):
    return in_range(load(spark, d, "events").select("event_id", "ts"), F.col("ts"), dt.datetime(2024, 1, 15))


@query("range_fallback_date", """
WITH docs AS (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS modified,
         ts + INTERVAL 3 DAY AS received FROM events)
SELECT event_id, coalesce(modified, received) AS progress FROM docs
WHERE coalesce(modified, received) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def _(spark, d):
    docs = load(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("modified"),
        (F.col("ts") + F.expr("INTERVAL 3 DAY")).alias("received"),
    )
    dates = [F.col("modified"), F.col("received")]
    kept = since_until_fallback(docs, dates, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20))
    return kept.select("event_id", progress_date(dates).alias("progress"))


@query("keyset_page", """
WITH first AS (SELECT max(event_id) AS k FROM
  (SELECT event_id FROM events ORDER BY event_id LIMIT 1000))
SELECT event_id, event_type FROM events, first WHERE event_id > k ORDER BY event_id LIMIT 1000""")
def _(spark, d):
    events = load(spark, d, "events").select("event_id", "event_type")
    cursor = next_cursor(keyset_page(events, "event_id", rows=PAGE), "event_id")
    return keyset_page(events, "event_id", cursor, PAGE)


@query("dedup_pages", "SELECT event_id, ts, event_type FROM events")
def _(spark, d):
    events = load(spark, d, "events").select("event_id", "ts", "event_type")
    return one_per_id(events.unionByName(events), ["event_id"])


@query("dedup_latest_version", """
SELECT o_orderkey, greatest(o_orderdate, max(l_shipdate)) AS modified
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate
UNION ALL SELECT o_orderkey, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(spark, d):
    first = load(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("modified"))
    later = load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("modified"))
    return one_per_id(first.unionByName(later), ["o_orderkey"], F.col("modified"))


@query("include_children", """
SELECT o_orderkey, count(l_orderkey) AS n_lines, coalesce(sum(l_quantity), 0) AS quantity,
       min(l_linenumber) AS first_line, max(l_linenumber) AS last_line
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey")
    docs = inline_children(orders, load(spark, d, "lineitem"), "o_orderkey", "l_orderkey", "lines")
    quantity = F.aggregate(F.col("lines.l_quantity"), F.lit(0.0), lambda a, x: a + x)
    return docs.select(
        "o_orderkey", F.size("lines").cast("long").alias("n_lines"), quantity.alias("quantity"),
        F.array_min("lines.l_linenumber").alias("first_line"), F.array_max("lines.l_linenumber").alias("last_line"),
    )


@query("related_rows", """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rows = related_rows(orders, lines, "o_orderkey", "l_orderkey", "line")
    return rows.select("o_orderkey", "o_orderstatus", "line.l_linenumber", "line.l_partkey", "line.l_quantity")
