"""Queries over nested documents: paths, unnesting, filters on lists, exports."""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    auto_id, cell_text, descendants, distinct_items, dynamic_field, each, each_present, field, index_at,
    index_range, is_empty, is_truthy, items_where, join_items, length_of, unwrap_single,
    variant_field, variant_list, variant_missing, words, xml_text,
)
from ..operators import (
    bind, child_or_root_rows, child_rows, child_rows_at, is_root_row, named_scope, present_rows,
)
from ..plans import ColumnSpec, ExportSpec, export, export_routed, with_actor
from ..session import fresh_dir
from ..sources import inline_children, typed_documents
from ..sources.tables import DocTable, load
from .base import LINES, documents, forms, query


@query("project_fields", """
SELECT doc_id AS id, lang AS form_name, 'c' || doc_id AS case_id, 'u' || n_chars AS user_id
FROM documents""")
def _(spark, d):
    return documents(spark, d).select(
        field("id"), field("form", "name").alias("form_name"),
        field("form", "case", "@case_id").alias("case_id"), field("metadata", "userID").alias("user_id"),
    )


@query("project_variant", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.absent') AS absent, true AS missing FROM events""")
def _(spark, d):
    docs = load(spark, d, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    doc = F.col("doc")
    return docs.select(
        "event_id", variant_field(doc, "k", as_type="bigint").alias("k"),
        variant_field(doc, "absent").alias("absent"), variant_missing(doc, "absent").alias("missing"),
    )


@query("missing_or_null", """
SELECT o_orderkey, o_orderstatus = 'P' AS missing, o_orderstatus = 'O' AS stored_null FROM orders""")
def _(spark, d):
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("{}"))
        .when(F.col("o_orderstatus") == "O", F.lit('{"v":null}')).otherwise(F.lit('{"v":1}'))
    )
    docs = load(spark, d, "orders").select("o_orderkey", F.parse_json(text).alias("doc"))
    found = variant_field(F.col("doc"), "v", as_type="variant")
    return docs.select(
        "o_orderkey", variant_missing(F.col("doc"), "v").alias("missing"),
        F.coalesce(F.is_variant_null(found), F.lit(False)).alias("stored_null"),
    )


@query("xml_unwrap", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN ''
       ELSE '{"t":' || o_custkey || '}' END AS cell FROM orders""")
def _(spark, d):
    shaped = (
        F.when(F.col("o_orderstatus") == "F", F.to_json(F.create_map(
            F.lit("#text"), F.col("o_orderpriority"), F.lit("@kind"), F.lit("x"), F.lit("id"), F.lit("n"))))
        .when(F.col("o_orderstatus") == "O", F.lit('{"@kind":"x","id":"n"}'))
        .otherwise(F.to_json(F.struct(F.col("o_custkey").alias("t"))))
    )
    docs = load(spark, d, "orders").select("o_orderkey", F.parse_json(shaped).alias("cell"))
    return docs.select("o_orderkey", xml_text(F.col("cell"), T.VariantType()).alias("cell"))


@query("xml_unwrap_struct", """
SELECT doc_id AS id, source AS cell FROM documents""")
def _(spark, d):
    docs = documents(spark, d)
    dtype = docs.schema["form"].dataType["case"].dataType
    with_text = xml_text(field("form", "case"), T.StructType(
        [f for f in dtype.fields if f.name.startswith(("@", "#"))]))
    return docs.select("id", with_text.alias("cell"))


@query("collapsed_list", """
SELECT p_partkey, w AS item, CAST(i AS BIGINT) AS pos FROM (
  SELECT p_partkey, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
    SELECT p_partkey, CASE WHEN p_size > 25 THEN string_split(p_name, ' ') ELSE [p_name] END AS ws FROM part))""")
def _(spark, d):
    many = F.to_json(F.struct(F.split("p_name", " ").alias("foo")))
    lone = F.to_json(F.struct(F.col("p_name").alias("foo")))
    docs = load(spark, d, "part").select(
        "p_partkey", F.parse_json(F.when(F.col("p_size") > 25, many).otherwise(lone)).alias("doc"))
    items = variant_list(variant_field(F.col("doc"), "foo", as_type="variant"))
    rows = child_rows_at(docs.select("p_partkey", items.alias("items")), F.col("items"), "item")
    return rows.select(
        "p_partkey", F.try_variant_get("item", "$", "string").alias("item"),
        F.col("pos").cast("bigint").alias("pos"),
    )


@query("index_slice", """
SELECT doc_id AS id, parts[1] AS first_line, parts[len(parts)] AS last_line, parts[50] AS far_line,
       array_to_string(parts[2:3], '|') AS middle
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""")
def _(spark, d):
    texts = each(field("form", "lines"), "text")
    return documents(spark, d).select(
        "id", index_at(texts, 0).alias("first_line"), index_at(texts, -1).alias("last_line"),
        index_at(texts, 49).alias("far_line"),
        F.array_join(index_range(texts, 1, 3), "|").alias("middle"),
    )


@query("wildcard_list", f"""
WITH {LINES}
SELECT doc_id AS id, string_agg(CAST(length(line) AS VARCHAR), ',' ORDER BY pos) AS sizes,
       coalesce(string_agg(CASE WHEN length(line) > 60 THEN substring(line, 1, 8) END, ',' ORDER BY pos), '---') AS notes
FROM lines GROUP BY doc_id""")
def _(spark, d):
    lines = field("form", "lines")
    return documents(spark, d).select(
        "id", join_items(each(lines, "size")).alias("sizes"),
        cell_text(each_present(lines, "note"), T.ArrayType(T.StringType()), "---").alias("notes"),
    )


@query("descendants", f"""
WITH {LINES}
SELECT doc_id AS id,
       CAST(count(*) + count(*) FILTER (length(line) > 100) AS INTEGER) AS n,
       CAST(sum(length(line)) + coalesce(sum(length(line)) FILTER (length(line) > 100), 0) AS BIGINT) AS total
FROM lines GROUP BY doc_id""")
def _(spark, d):
    docs = documents(spark, d)
    sizes = docs.select("id", descendants(docs.schema, "size").alias("sizes"))
    total = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    return sizes.select("id", F.size("sizes").alias("n"), total.alias("total"))


@query("descendants_untyped", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) || ',' || user_id AS ks FROM events""")
def _(spark, d):
    """Documents without a schema: their type is found first, then walked."""
    texts = F.format_string('{"id":%d,"k":%d,"form":{"parts":[{"props":%s}]}}', "event_id", "user_id", "props")
    typed = typed_documents(load(spark, d, "events").select(F.parse_json(texts).alias("doc")))
    return typed.select(
        F.col("id").cast("bigint").alias("event_id"), F.array_join(descendants(typed.schema, "k"), ",").alias("ks"))


@query("export_paths", """
SELECT doc_id AS id, parts[1] AS first, parts[-1] AS last, parts[1] || coalesce(',' || parts[2], '') AS two,
       array_to_string(list_transform(parts, lambda x: CAST(length(x) AS VARCHAR)), ',') AS sizes, source AS tag
FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents)""")
def _(spark, d):
    """Elements by number, stretches, members at any depth and members of a map, in one spec."""
    docs = documents(spark, d).withColumn("tags", F.create_map(F.lit("site"), F.col("domain")))
    spec = ExportSpec("t", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("first", ("form", "lines", "[0]", "text")),
        ColumnSpec("last", ("form", "lines", "[-1]", "text")), ColumnSpec("two", ("form", "lines", "[0:2]", "text")),
        ColumnSpec("sizes", ("form", "..size")), ColumnSpec("tag", ("tags", "site"))))
    return export(DocTable(docs, "form"), spec)


@query("child_rows", f"""
WITH {LINES}
SELECT doc_id AS parent_id, source AS domain, line AS text, CAST(length(line) AS INTEGER) AS size FROM lines""")
def _(spark, d):
    rows = child_rows(documents(spark, d), field("form", "lines"), "line")
    return rows.select(F.col("id").alias("parent_id"), "domain", "line.text", "line.size")


@query("child_rows_pos_id", f"""
WITH {LINES}
SELECT doc_id || '.form.lines.[' || pos || ']' AS id, pos, CAST(length(line) AS INTEGER) AS size FROM lines""")
def _(spark, d):
    rows = child_rows_at(documents(spark, d), field("form", "lines"), "line")
    return rows.select(
        auto_id(F.col("id"), "form.lines", F.col("pos")).alias("id"),
        F.col("pos").cast("bigint").alias("pos"), "line.size",
    )


@query("value_or_root", f"""
WITH {LINES}, long AS (SELECT * FROM lines WHERE length(line) > 100)
SELECT d.doc_id AS doc, d.source AS domain, CAST(length(l.line) AS INTEGER) AS size, l.doc_id IS NULL AS is_root
FROM documents d LEFT JOIN long l ON l.doc_id = d.doc_id""")
def _(spark, d):
    rows = child_or_root_rows(documents(spark, d), F.col("remarks"), "remark")
    return rows.select(F.col("id").alias("doc"), "domain", "remark.size", is_root_row().alias("is_root"))


@query("scalar_array", r"""
SELECT conv_id, turn, unnest([w FOR w IN string_split_regex(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+') IF w <> '']) AS word
FROM conversations""")
def _(spark, d):
    turns = load(spark, d, "conversations").select("conv_id", "turn", words(F.col("text")).alias("w"))
    return child_rows(turns, F.col("w"), "word").select("conv_id", "turn", "word")


@query("present_values", f"""
WITH {LINES}
SELECT doc_id AS id, substring(line, 1, 8) AS note FROM lines WHERE length(line) > 60""")
def _(spark, d):
    rows = present_rows(documents(spark, d), field("form", "lines"), "note", "note")
    return rows.select("id", "note")


@query("named_scope", """
SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders""")
def _(spark, d):
    rows = named_scope(load(spark, d, "orders"), "o")
    return rows.select("o_orderkey", F.col("o.o_orderstatus").alias("status"), F.col("o.o_totalprice").alias("price"))


@query("bind_reuse", """
SELECT l_orderkey, l_linenumber, l_quantity * 2 AS doubled, l_quantity * 2 + 1 AS next FROM lineitem""")
def _(spark, d):
    rows = bind(load(spark, d, "lineitem"), "doubled", F.col("l_quantity") * 2)
    return rows.select("l_orderkey", "l_linenumber", "doubled", (F.col("doubled") + 1).alias("next"))


@query("dynamic_ref", """
SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR)
       WHEN 'error' THEN props END AS chosen FROM events""")
def _(spark, d):
    members = F.create_map(
        F.lit("click"), F.col("user_id").cast("string"), F.lit("error"), F.col("props"))
    return load(spark, d, "events").select(
        "event_id", dynamic_field(members, F.col("event_type")).alias("chosen"))


@query("array_filter", f"""
WITH {LINES}
SELECT doc_id AS id, count(*) FILTER (length(line) > 40 AND length(line) <= 80) AS n FROM lines GROUP BY doc_id""")
def _(spark, d):
    kept = items_where(field("form", "lines"), lambda x: (x.getField("size") > 40) & (x.getField("size") <= 80))
    return documents(spark, d).select("id", F.size(kept).cast("bigint").alias("n"))


@query("empty_filter", f"""
WITH {LINES}
SELECT doc_id AS id FROM lines GROUP BY doc_id HAVING max(length(line)) <= 100""")
def _(spark, d):
    docs = documents(spark, d)
    return docs.where(is_empty(F.col("remarks"), docs.schema["remarks"].dataType)).select("id")


@query("truthy_filter", f"""
WITH {LINES}, per AS (
  SELECT doc_id AS id, max(length(line)) > 100 AS has_remarks,
         bool_or(pos = 0 AND line <> '') AS starts FROM lines GROUP BY doc_id)
SELECT id, has_remarks, starts FROM per WHERE starts""")
def _(spark, d):
    docs = documents(spark, d)
    first = index_at(each(field("form", "lines"), "text"), 0)
    rows = docs.select(
        "id", is_truthy(F.col("remarks"), docs.schema["remarks"].dataType).alias("has_remarks"),
        is_truthy(first, T.StringType()).alias("starts"),
    )
    return rows.where(is_truthy(F.col("starts"), T.BooleanType()))


@query("list_unique", f"""
WITH {LINES}
SELECT doc_id AS id, string_agg(DISTINCT CAST(length(line) AS VARCHAR), ',' ORDER BY CAST(length(line) AS VARCHAR)) AS sizes
FROM lines GROUP BY doc_id""")
def _(spark, d):
    sizes = F.transform(each(field("form", "lines"), "size"), lambda x: x.cast("string"))
    return documents(spark, d).select("id", join_items(distinct_items(sizes)).alias("sizes"))


@query("list_measures", f"""
WITH {LINES}
SELECT doc_id AS id, count(*) AS n_lines, CAST(any_value(length(lang)) AS INTEGER) AS lang_length,
       CASE WHEN count(*) = 1 THEN any_value(line) END AS only_line
FROM lines GROUP BY doc_id""")
def _(spark, d):
    lines = field("form", "lines")
    return documents(spark, d).select(
        "id", length_of(lines, T.ArrayType(T.StringType())).cast("bigint").alias("n_lines"),
        length_of(field("form", "name"), T.StringType()).alias("lang_length"),
        unwrap_single(each(lines, "text")).alias("only_line"),
    )


# --- exports by spec -------------------------------------------------------

FORMS = ExportSpec(
    table="forms", resource="form", missing_value="---",
    columns=(
        ColumnSpec("id", ("id",)),
        ColumnSpec("language", ("form", "name")),
        ColumnSpec("case", ("form", "case", "@case_id"), map_via=("substr", 1, 9)),
        ColumnSpec("notes", ("form", "lines", "[*]", "note")),
        ColumnSpec("nothing", ("form", "absent")),
        ColumnSpec("case_cell", ("form", "case", "#text"), format_via=("template", "[{}]")),
    ),
)
REMARKS = ExportSpec(
    table="remarks", resource="form", root=("remarks", "[*]"), value_or_root=True,
    columns=(
        ColumnSpec("id", ("id",)),
        ColumnSpec("parent", ("$", "id")),
        ColumnSpec("size", ("size",), data_type="integer"),
        ColumnSpec("domain", ("domain",)),
    ),
)


@query("export_spec", f"""
WITH {LINES}, notes AS (
  SELECT doc_id, string_agg(CASE WHEN length(line) > 60 THEN substring(line, 1, 8) END, ',' ORDER BY pos) AS notes
  FROM lines GROUP BY doc_id)
SELECT CAST(d.doc_id AS VARCHAR) AS id, lang AS language, CAST(d.doc_id AS VARCHAR) AS "case",
       coalesce(notes, '---') AS notes, '---' AS nothing, '[' || source || ']' AS case_cell, 'u' || n_chars AS actor_id
FROM documents d JOIN notes n ON n.doc_id = d.doc_id
WHERE d.source IN ('src0', 'src1')""")
def _(spark, d):
    spec = replace(with_actor(FORMS), filters=(("domain", "src0"), ("domain", "src1")))
    return export(forms(spark, d), spec)


@query("export_value_or_root", f"""
WITH {LINES}, long AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM lines WHERE length(line) > 100)
SELECT d.doc_id || CASE WHEN l.doc_id IS NULL THEN '' ELSE '.remarks.[' || i || ']' END AS id,
       d.doc_id AS parent, CAST(length(l.line) AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS domain
FROM documents d LEFT JOIN long l ON l.doc_id = d.doc_id""")
def _(spark, d):
    return export(forms(spark, d), REMARKS)


@query("emit_many", f"""
WITH {LINES}
SELECT 'languages' AS tbl, CAST(doc_id AS VARCHAR) AS id, lang AS value FROM documents
UNION ALL
SELECT 'sizes', doc_id || '.form.lines.[' || pos || ']', CAST(length(line) AS VARCHAR) FROM lines""")
def _(spark, d):
    folder = fresh_dir(spark, "emit")
    specs = [
        ExportSpec("languages", "form", (
            ColumnSpec("id", ("id",), data_type="text"), ColumnSpec("value", ("form", "name")))),
        ExportSpec("sizes", "form", (
            ColumnSpec("id", ("id",)), ColumnSpec("value", ("size",), data_type="text")),
            root=("form", "lines")),
    ]
    tables, _ = export_routed(forms(spark, d), specs, folder)
    parts = [tables.table(s.table).select(F.lit(s.table).alias("tbl"), "id", "value") for s in specs]
    return parts[0].unionByName(parts[1])


@query("emit_rejects", f"""
WITH {LINES}, cells AS (
  SELECT 'lines' AS tbl, doc_id AS id, 'size' AS "column", substring(line, 1, 8) AS value FROM lines
  UNION ALL SELECT 'lines', doc_id, 'day', source FROM lines
  UNION ALL SELECT 'docs', doc_id, 'lang', lang FROM documents)
SELECT tbl, CAST(id AS VARCHAR) AS id, "column", value FROM cells
WHERE value IS NOT NULL AND NOT ("column" = 'size' AND TRY_CAST(value AS BIGINT) IS NOT NULL)""")
def _(spark, d):
    """Cells of two tables that do not fit their declared types, from the pass that writes the tables."""
    specs = [
        ExportSpec("docs", "form", (ColumnSpec("id", ("id",)), ColumnSpec("lang", ("form", "name"), data_type="boolean"))),
        ExportSpec("lines", "form", (
            ColumnSpec("id", ("id",)), ColumnSpec("size", ("text",), map_via=("substr", 0, 8), data_type="integer"),
            ColumnSpec("day", ("$", "domain"), data_type="date")), root=("form", "lines")),
    ]
    tables, _ = export_routed(forms(spark, d), specs, fresh_dir(spark, "emit"))
    return tables.rejects().withColumnRenamed("table", "tbl")


@query("actor_id", "SELECT o_orderkey AS id, 'c' || o_custkey AS actor_id FROM orders")
def _(spark, d):
    cases = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("c"), "o_custkey").alias("user_id"))
    spec = with_actor(ExportSpec("cases", "case", (ColumnSpec("id", ("id",)),)))
    return export(DocTable(cases, "case"), spec)


@query("alt_fields", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
                        WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS found FROM orders""")
def _(spark, d):
    docs = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("a"),
        F.when(F.col("o_orderstatus") == "O", F.lit("")).alias("b"),
        F.col("o_custkey").cast("string").alias("c"),
    )
    spec = ExportSpec("t", "case", (
        ColumnSpec("o_orderkey", ("o_orderkey",)),
        ColumnSpec("found", ("a",), alternates=(("b",), ("absent",), ("c",))),
    ))
    return export(DocTable(docs, "case"), spec)


@query("typed_output", """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS DATE) AS day, CAST(trunc(value) AS BIGINT) AS whole,
       value > 0 AS positive, CAST(user_id AS VARCHAR) AS user_text FROM events""")
def _(spark, d):
    docs = load(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"), "ts", "value", "user_id",
        (F.col("value") > 0).cast("string").alias("flag"))
    spec = ExportSpec("typed", "form", (
        ColumnSpec("id", ("id",)), ColumnSpec("day", ("ts",), data_type="date"),
        ColumnSpec("whole", ("value",), data_type="integer"),
        ColumnSpec("positive", ("flag",), data_type="boolean"),
        ColumnSpec("user_text", ("user_id",), data_type="text"),
    ))
    return export(DocTable(docs, "form"), spec)


@query("export_variant", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type, json_extract_string(props, '$.k') AS k, 'none' AS absent,
       CAST(value AS DOUBLE) AS value FROM events""")
def _(spark, d):
    """The same kind of spec on documents without a schema."""
    docs = load(spark, d, "events").select(F.to_variant_object(F.struct(
        F.col("event_id").alias("id"), "event_type", "value", F.from_json("props", "k int").alias("props"))).alias("doc"))
    spec = ExportSpec("t", "ucr", (
        ColumnSpec("id", ("id",)), ColumnSpec("event_type", ("event_type",)), ColumnSpec("k", ("props", "k")),
        ColumnSpec("absent", ("nowhere", "at", "all")), ColumnSpec("value", ("value",)),
    ), missing_value="none")
    out = export(DocTable(docs, "ucr", variant="doc"), spec)
    return out.withColumn("value", F.col("value").cast("double"))


@query("export_urls", f"""
WITH {LINES}
SELECT 'https://h/a/' || source || '/reports/form_data/' || doc_id || '/' AS form,
       CASE WHEN length(line) > 60 THEN
         'https://h/a/' || source || '/api/form/attachment/' || doc_id || '/' || substring(line, 1, 8) END AS photo,
       lang || ':' || source AS both
FROM lines""")
def _(spark, d):
    spec = ExportSpec("t", "form", (
        ColumnSpec("form", ("$", "id"), format_via=("form_url",)),
        ColumnSpec("photo", ("note",), map_via=("attachment_url",)),
        ColumnSpec("both", ("text",), map_via=("template", "{}:{}", ("$", "form", "name"), ("$", "domain"))),
    ), root=("form", "lines"), base_url="https://h")
    return export(forms(spark, d), spec)


@query("inlined_export", """
SELECT o_orderkey AS parent, l_linenumber AS line, l_quantity AS quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def _(spark, d):
    """Related documents inlined, then exported as rows of their own, childless parents included."""
    orders = load(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    docs = inline_children(orders, load(spark, d, "lineitem"), "id", "l_orderkey", "lines")
    spec = ExportSpec("lines", "case", (
        ColumnSpec("parent", ("$", "id")), ColumnSpec("line", ("l_linenumber",)),
        ColumnSpec("quantity", ("l_quantity",))), root=("lines",), value_or_root=True)
    return export(DocTable(docs, "case"), spec)
