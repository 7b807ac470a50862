"""Queries over the function library; each runs on a whole table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    FUNCTIONS, add, attachment_url, attachment_urls, bool_to_int, call, count_selected, default_value,
    divide, doc_url, first_present, floor_divide, format_uuid, join_text, multiply, register,
    register_row_function, selected, selected_at, sha1_text, substr_range, subtract, template,
    to_bool, to_datetime, to_exact_number, to_integer, to_json_text, to_number, variant_cell, via,
)
from ..sources.tables import load
from .base import query

# White space as the Spark side splits on it.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
BASE = "https://data.example.org"


@query("arith", """
SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber AS a, l_quantity - l_linenumber AS s,
       l_quantity * l_linenumber AS m, CAST(floor((l_linenumber - 4) / 2.0) AS BIGINT) AS f,
       9007199254740993 - l_orderkey AS exact,
       l_quantity / l_linenumber AS d, l_returnflag || l_linestatus AS t,
       l_quantity >= 25 AS ge, l_quantity < 25 AS lt FROM lineitem""")
def _(spark, d):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", add(q, n).alias("a"), subtract(q, n).alias("s"),
        multiply(q, n).alias("m"), floor_divide(n - 4, F.lit(2)).alias("f"),
        floor_divide(9007199254740993 - F.col("l_orderkey"), F.lit(1)).alias("exact"), divide(q, n).alias("d"),
        add(F.col("l_returnflag"), F.col("l_linestatus"), T.StringType()).alias("t"),
        call(">=", q, F.lit(25)).alias("ge"), call("<", q, F.lit(25)).alias("lt"),
    )


@query("divide_lenient", """
SELECT l_orderkey, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio FROM lineitem""")
def _(spark, d):
    return load(spark, d, "lineitem").select(
        "l_orderkey", divide(F.col("l_tax"), F.col("l_discount"), lenient=True).alias("ratio"))


FLAG = "CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'no' WHEN 'P' THEN NULL ELSE '1' END"


@query("to_bool", f"""
SELECT o_orderkey, coalesce(lower({FLAG}) IN ('true', 't', '1'), false) AS flag,
       CAST(coalesce(lower({FLAG}) IN ('true', 't', '1'), false) AS INTEGER) AS flag_int FROM orders""")
def _(spark, d):
    text = (
        F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "no")
        .when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise("1")
    )
    return load(spark, d, "orders").select(
        "o_orderkey", to_bool(text).alias("flag"), bool_to_int(text).alias("flag_int"))


@query("to_num", """
SELECT o_orderkey, TRY_CAST(v AS DOUBLE) AS num, CASE WHEN regexp_matches(v, '^[0-9]+$') THEN TRY_CAST(v AS BIGINT) END AS whole,
       CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_totalprice AS DOUBLE) AS VARCHAR)
         WHEN 'O' THEN CAST(9007199254740993 + o_custkey AS VARCHAR) END AS exact,
       '12345678901234567890' || (100000 + o_orderkey) AS long
FROM (SELECT o_orderstatus, o_totalprice, o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_totalprice AS VARCHAR)
             WHEN 'O' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS v FROM orders)""")
def _(spark, d):
    v = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string"))
        .otherwise(F.col("o_orderpriority"))
    )
    big = F.when(F.col("o_orderstatus") == "O", (F.lit(9007199254740993) + F.col("o_custkey")).cast("string")).otherwise(v)
    long = F.concat(F.lit("12345678901234567890"), (100000 + F.col("o_orderkey")).cast("string"))
    return load(spark, d, "orders").select(
        "o_orderkey", to_number(v).alias("num"), to_integer(v).alias("whole"),
        variant_cell(to_exact_number(big)).alias("exact"), variant_cell(to_exact_number(long)).alias("long"))


@query("to_date", """
SELECT event_id,
  date_trunc('second', ts) - CASE event_type WHEN 'click' THEN INTERVAL 150 MINUTE WHEN 'view' THEN -INTERVAL 480 MINUTE
       ELSE INTERVAL 0 MINUTE END AS at,
  date_trunc('day', ts) AS day FROM events""")
def _(spark, d):
    ts = F.col("ts").cast("string")
    suffix = F.when(F.col("event_type") == "click", "+02:30").when(F.col("event_type") == "view", "-0800").otherwise("Z")
    date = F.substring(ts, 1, 10)
    other = F.concat_ws("/", F.substring(date, 9, 2), F.substring(date, 6, 2), F.substring(date, 1, 4))
    return load(spark, d, "events").select(
        "event_id", to_datetime(F.concat(F.replace(ts, F.lit(" "), F.lit("T")), suffix)).alias("at"),
        to_datetime(other, "dd/MM/yyyy").alias("day"),
    )


@query("to_date_bad", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS at FROM events""")
def _(spark, d):
    text = F.when(F.col("event_type") == "error", F.lit("日")).otherwise(F.col("ts").cast("string"))
    return load(spark, d, "events").select("event_id", to_datetime(text).alias("at"))


@query("to_json", """
SELECT o_orderkey, '{"custkey":' || o_custkey || ',"status":"' || o_orderstatus || '"}' AS doc,
       o_orderpriority AS plain FROM orders""")
def _(spark, d):
    orders = load(spark, d, "orders")
    pair = F.struct(F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"))
    return orders.select(
        "o_orderkey", to_json_text(pair, T.StructType()).alias("doc"),
        to_json_text(F.col("o_orderpriority"), T.StringType()).alias("plain"))


@query("uuid_format", r"""
SELECT doc_id, CASE WHEN lang <> 'en' THEN regexp_replace(md5(text), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') END AS u
FROM documents""")
def _(spark, d):
    digest = F.md5("text")
    value = F.when(F.col("lang") == "en", F.substring(digest, 1, 20)).otherwise(digest)
    return load(spark, d, "documents").select("doc_id", format_uuid(value).alias("u"))


@query("sha1_hash", """
SELECT c_custkey, sha1(c_name) AS h, sha1(CAST(c_custkey AS VARCHAR)) AS hn FROM customer""")
def _(spark, d):
    return load(spark, d, "customer").select(
        "c_custkey", sha1_text(F.col("c_name")).alias("h"), sha1_text(F.col("c_custkey")).alias("hn"))


@query("selected_at", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word,
       CAST(NULL AS VARCHAR) AS fifth, 'Error: index must be an integer' AS wrong FROM part""")
def _(spark, d):
    name = F.col("p_name")
    return load(spark, d, "part").select(
        "p_partkey", selected_at(name, 0).alias("first_word"), selected_at(name, "-1").alias("last_word"),
        selected_at(name, 5).alias("fifth"), selected_at(name, "x").alias("wrong"))


@query("selected", """
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS red,
       list_contains(string_split(p_name, ' '), 're') AS re FROM part""")
def _(spark, d):
    name = F.col("p_name")
    return load(spark, d, "part").select(
        "p_partkey", selected(name, "red").alias("red"), selected(name, "re").alias("re"))


@query("count_selected", f"""
SELECT doc_id, CASE WHEN text <> '' THEN len([w FOR w IN string_split_regex(text, '{WS}') IF w <> '']) END AS n
FROM documents""")
def _(spark, d):
    return load(spark, d, "documents").select("doc_id", count_selected(F.col("text")).cast("bigint").alias("n"))


@query("substr_range", """
SELECT p_partkey, substring(p_name, 3, 4) AS middle, '' AS none, CAST(NULL AS VARCHAR) AS negative,
       substring(CAST(p_partkey AS VARCHAR), 2, 2) AS digits FROM part""")
def _(spark, d):
    name = F.col("p_name")
    return load(spark, d, "part").select(
        "p_partkey", substr_range(name, 2, 6).alias("middle"), substr_range(name, 6, 2).alias("none"),
        substr_range(name, -2, 6).alias("negative"), substr_range(F.col("p_partkey"), 1, 3).alias("digits"))


@query("substr_text", "SELECT doc_id, substring(text, 11, 100) AS piece FROM documents")
def _(spark, d):
    return load(spark, d, "documents").select("doc_id", substr_range(F.col("text"), 10, 110).alias("piece"))


@query("join_text", """
SELECT o_orderkey, concat_ws('.', o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, CAST(o_custkey AS VARCHAR)) AS joined
FROM orders""")
def _(spark, d):
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return load(spark, d, "orders").select(
        "o_orderkey", join_text(".", F.col("o_orderstatus"), priority, F.col("o_custkey")).alias("joined"))


@query("template_text", """
SELECT o_orderkey, o_orderstatus || '/' || o_custkey || '!' AS filled,
       '{' || lpad(CAST(o_custkey AS VARCHAR), 12, '.') || '}' || rpad(o_orderstatus, 3, ' ') || o_custkey AS padded FROM orders""")
def _(spark, d):
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    return load(spark, d, "orders").select(
        "o_orderkey", template("{}/{}!", status, customer).alias("filled"),
        template("{{{1:.>12}}}{0:3}{1}", status, customer).alias("padded"))


@query("default_value", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'none' END AS label,
       CASE WHEN o_custkey <> 0 THEN o_custkey ELSE -1 END AS customer FROM orders""")
def _(spark, d):
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).when(F.col("o_orderstatus") == "O", "")
    return load(spark, d, "orders").select(
        "o_orderkey", default_value(text, "none", T.StringType()).alias("label"),
        default_value(F.col("o_custkey"), F.lit(-1).cast("bigint"), T.LongType()).alias("customer"))


@query("first_present", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'F' THEN o_orderpriority END AS found,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS n FROM orders""")
def _(spark, d):
    blank = F.when(F.col("o_orderstatus") == "O", "")
    other = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    one = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a"))).otherwise(F.array().cast("array<string>"))
    two = F.array(F.lit("b"), F.lit("c"))
    return load(spark, d, "orders").select(
        "o_orderkey", first_present(blank, other).alias("found"),
        F.size(first_present(one, two, dtype=T.ArrayType(T.StringType()))).alias("n"))


@query("doc_urls", f"""
SELECT o_orderkey, '{BASE}/a/' || o_orderstatus || '/reports/form_data/' || o_orderkey || '/' AS form,
       '{BASE}/a/' || o_orderstatus || '/reports/case_data/' || o_orderkey || '/' AS "case",
       CASE WHEN o_orderpriority <> '5-LOW' THEN '{BASE}/a/' || o_orderstatus || '/api/form/attachment/' || o_orderkey || '/' || o_orderpriority END AS photo,
       '{BASE}/a/' || o_orderstatus || '/api/form/attachment/' || o_orderkey || '/a.jpg,' ||
       '{BASE}/a/' || o_orderstatus || '/api/form/attachment/' || o_orderkey || '/b.jpg' AS photos
FROM orders""")
def _(spark, d):
    domain, key = F.col("o_orderstatus"), F.col("o_orderkey")
    name = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("")
    names = F.array(F.lit("a.jpg"), F.lit("b.jpg"))
    return load(spark, d, "orders").select(
        "o_orderkey", doc_url("form", BASE, domain, key).alias("form"),
        doc_url("case", BASE, domain, key).alias("case"),
        attachment_url(BASE, domain, key, name).alias("photo"),
        F.array_join(attachment_urls(BASE, domain, key, names), ",").alias("photos"))


@query("map_then_format", """
SELECT p_partkey, '<' || string_split(p_name, ' ')[2] || '>' AS a, substring(p_name, 1, 3) AS b,
       'Error: selected-at index must be an integer: selected-at(x)' AS c FROM part""")
def _(spark, d):
    name = F.col("p_name")
    return load(spark, d, "part").select(
        "p_partkey", via("template", "<{}>")(via("selected-at", 1)(name)).alias("a"),
        via("substr", 0, 3)(name).alias("b"), via("selected-at", "x")(name).alias("c"))


@query("registered_fn", """
SELECT c_custkey, upper(c_name) || '!' AS loud, c_custkey // 2 AS half FROM customer""")
def _(spark, d):
    if "shout" not in FUNCTIONS:
        # A nested function travels to the workers by value.
        register("shout", lambda v: F.concat(F.upper(v), F.lit("!")))
        register_row_function("half", lambda values: values // 2, "bigint")
    return load(spark, d, "customer").select(
        "c_custkey", call("shout", F.col("c_name")).alias("loud"), call("half", F.col("c_custkey")).alias("half"))
