"""Queries over lists in lists and over lists of documents without a schema."""

from pyspark.sql import functions as F

from ..plans import ColumnSpec, ExportSpec, export
from ..sources.tables import DocTable, load
from .base import LINES, documents, query

WORDS = f"""
WITH {LINES}, words AS (
  SELECT doc_id, pos, i, string_split(line, ' ')[i + 1] AS word, length(line) AS size
  FROM (SELECT *, unnest(range(len(string_split(line, ' ')))) AS i FROM lines))"""
NESTED_SQL = WORDS + """
SELECT doc_id || '.lines.[' || pos || '].words.[' || i || ']' AS id, CAST(doc_id AS VARCHAR) AS doc, word FROM words"""
NESTED = ExportSpec("words", "form", (
    ColumnSpec("id", ("id",)), ColumnSpec("doc", ("$", "id"), data_type="text"), ColumnSpec("word", ("word",)),
), root=("lines", "[*]", "words", "[*]"))


def texts(spark, d):
    """Documents with their lines, and in each line its words."""
    word = lambda w: F.struct(w.alias("word"))
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(
        F.length(line).alias("size"), F.transform(F.split(line, " "), word).alias("words")))
    return load(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("name"), lines.alias("lines"))


@query("nested_ids", NESTED_SQL)
def _(spark, d):
    return export(DocTable(texts(spark, d), "form"), NESTED)


@query("nested_ids_variant", NESTED_SQL)
def _(spark, d):
    docs = texts(spark, d).select(F.to_variant_object(F.struct("id", "name", "lines")).alias("doc"))
    return export(DocTable(docs, "form", variant="doc"), NESTED)


@query("nested_value_or_root", f"""
WITH {LINES}, words AS (
  SELECT doc_id, pos, unnest(list_filter(range(len(string_split(line, ' '))), lambda i: length(string_split(line, ' ')[i + 1]) > 12)) AS i
  FROM lines)
SELECT CASE WHEN i IS NULL THEN CAST(d.doc_id AS VARCHAR) ELSE d.doc_id || '.lines.[' || pos || '].long.[' || k || ']' END AS id,
       d.lang AS lang
FROM documents d LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY i) - 1 AS k FROM words) w ON w.doc_id = d.doc_id""")
def _(spark, d):
    """Long words, or the document itself where no line has any."""
    long = lambda line: F.struct(F.filter(F.split(line, " "), lambda w: F.length(w) > 12).alias("long"))
    docs = load(spark, d, "documents").select(
        F.col("doc_id").alias("id"), "lang", F.transform(F.split("text", "\n"), long).alias("lines"))
    spec = ExportSpec("t", "form", (ColumnSpec("id", ("id",)), ColumnSpec("lang", ("$", "lang"))), root=("lines", "long"), value_or_root=True)
    return export(DocTable(docs, "form"), spec)


@query("variant_lists", """
SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(list_sort(list_distinct(list_transform(parts, lambda x: length(x)))), ',') AS sizes,
       array_to_string(list_sort(list_distinct(words)), ',') AS words, CAST(len(parts) AS VARCHAR) AS n_sizes,
       CAST(len(list_distinct(words)) AS VARCHAR) AS n_words, CAST(length(lang) AS VARCHAR) AS name_length
FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS parts, string_split(string_split(text, chr(10))[1], ' ') AS words FROM documents)""")
def _(spark, d):
    """Distinct elements and lengths of lists in documents without a schema."""
    lines = F.split("text", "\n")
    text = F.to_json(F.struct(
        F.col("doc_id").alias("id"), F.col("lang").alias("name"), F.transform(lines, F.length).alias("sizes"),
        F.split(F.get(lines, F.lit(0)), " ").alias("words")))
    docs = load(spark, d, "documents").select(F.parse_json(text).alias("doc"))
    spec = ExportSpec("t", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("sizes", ("sizes",), map_via=("unique",)),
        ColumnSpec("words", ("words", "[*]"), map_via=("unique",)), ColumnSpec("n_sizes", ("sizes",), map_via=("len",), data_type="text"),
        ColumnSpec("n_words", ("words",), map_via=("unique",), format_via=("len",), data_type="text"),
        ColumnSpec("name_length", ("name",), map_via=("len",), data_type="text")))
    return export(DocTable(docs, "form", variant="doc"), spec)


@query("descendants_variant", f"""
WITH {LINES}
SELECT 'documents' AS tbl, doc_id AS id, array_to_string(
         list(length(line) ORDER BY pos) || coalesce(list(length(line) ORDER BY pos) FILTER (length(line) > 100), []), ',') AS found,
       count(*) + count(*) FILTER (length(line) > 100) AS n
FROM lines GROUP BY doc_id
UNION ALL
SELECT 'events', event_id, user_id || ',' || json_extract_string(props, '$.k'), 2 FROM events""")
def _(spark, d):
    """Members of one name at any depth of documents without a schema."""
    docs = documents(spark, d)
    docs = docs.select("id", F.to_variant_object(F.struct(*docs.columns)).alias("doc"))
    text = F.format_string('{"k":%d,"form":{"parts":[{"props":%s}]}}', "user_id", "props")
    events = load(spark, d, "events").select(F.col("event_id").alias("id"), F.parse_json(text).alias("doc"))
    parts = []
    for table, rows, name in (("documents", docs, "size"), ("events", events, "k")):
        found = (f"..{name}",)
        spec = ExportSpec(table, "form", (ColumnSpec("found", found), ColumnSpec("n", found, map_via=("len",), data_type="integer")))
        own = export(DocTable(rows, "form", variant="doc"), spec, carry={"id": F.col("id")})
        parts.append(own.select(F.lit(table).alias("tbl"), "id", "found", "n"))
    return parts[0].unionByName(parts[1])


@query("open_slices", """
SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(parts[2:], '|') AS rest, array_to_string(parts[:2], '|') AS head,
       array_to_string(list_filter(parts, lambda x, i: i % 2 = 1), '|') AS odd, array_to_string(list_reverse(parts)[:2], '|') AS back,
       lang || '!' AS marked
FROM (SELECT doc_id, lang, list_transform(string_split(text, chr(10)), lambda x: CAST(length(x) AS VARCHAR)) AS parts FROM documents)""")
def _(spark, d):
    """Stretches with open ends, with a step and backwards, and texts joined by ``+``."""
    docs = documents(spark, d)
    lines = lambda step: ("form", "lines", step, "size")
    spec = ExportSpec("t", "form", (
        ColumnSpec("id", ("id",), data_type="text"), ColumnSpec("rest", lines("[1:]")), ColumnSpec("head", lines("[:2]")),
        ColumnSpec("odd", lines("[::2]")), ColumnSpec("back", lines("[:-3:-1]")),
        ColumnSpec("marked", ("form", "name"), map_via=("+", "!"))))
    out = export(DocTable(docs, "form"), spec)
    joined = {c: F.coalesce(F.translate(c, ",", "|"), F.lit("")) for c in ("rest", "head", "odd", "back")}
    return out.withColumns(joined)
