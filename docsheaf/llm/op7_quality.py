"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line that many documents of one host hold is furniture of that host: menus,
notices, footers. Lines are normalised (case, digits, spaces), hashed together
with their host and counted over distinct documents. Lines above the limit go;
a document that keeps too small a share of its words without them is depleted
and rejected. Documents that fail the base rules are rejected before.

Hot lines and hosts: documents are counted per (line, document) first and per
line after partial sums. The frequent lines are written down, so that the join
back is one of two plain tables, broadcast if measured small and otherwise
shuffled with hot lines split.

Cases: a null or empty text has no words and fails the base rules. A null
source is a host of its own. Rows repeated in full count as one document and
get the same result each. Further columns of the input are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, staged, table, words

MAX_DOCS = 20
MIN_LEFT = 0.3
MIN_WORDS = 50
# White space of the contract, and the characters it calls symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: without(line, BLANKS) != "")


def line_key(line: Column, host: Column) -> Column:
    """One number for a normalised line of a host."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), SPACE, " ")
    return F.xxhash64(host, F.trim(plain))


def with_repeats(rows: DataFrame) -> DataFrame:
    """Replace ``words`` by ``n_words`` and ``n_repeat_words``.

    Windows are sorted by hash, so that equal ones are neighbours. Each
    repeated window covers its words; overlaps count once. The arrays are
    columns of their own, so that no lambda computes them anew.
    """
    n = F.size("words")
    window = lambda i: F.struct(
        F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))
    found = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    rows = rows.withColumn("n_words", n.cast("long")).withColumn("sorted", F.sort_array(found)).drop("words")
    hash_at = lambda i: F.get("sorted", i).getField("h")
    twice = lambda x, i: F.coalesce((hash_at(i - 1) == x.getField("h")) | (hash_at(i + 1) == x.getField("h")), F.lit(False))
    at = F.sort_array(F.transform(F.filter("sorted", twice), lambda x: x.getField("p")))
    rows = rows.withColumn("at", at).drop("sorted")
    covered = F.aggregate(
        "at", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a.getField("n") + F.least(F.lit(WINDOW), p - a.getField("last"))).alias("n")),
        lambda a: a.getField("n"))
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def base_figures(docs: DataFrame) -> DataFrame:
    """The base columns per row, with ``row_key`` equal for rows repeated in full."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = lines(F.col("body"))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "source", "text").alias("row_key"), text.alias("body"))
    rows = rows.select(
        "doc_id", "row_key", words(F.col("body")).alias("words"),
        F.length(without(F.col("body"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("body") - F.length(without(F.col("body"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(held) - F.size(F.array_distinct(held))).cast("long").alias("n_dup_lines"))
    rows = with_repeats(rows)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def line_rows(docs: DataFrame) -> DataFrame:
    """(row_key, line, n) for every line with a word; n is its words."""
    rows = docs.select(F.xxhash64("doc_id", "source", "text").alias("row_key"), "source", F.explode(lines(F.col("text"))).alias("line"))
    return rows.select("row_key", line_key(F.col("line"), F.col("source")).alias("line"), F.size(words(F.col("line"))).cast("long").alias("n"))


def frequent_lines(rows: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The line keys that more than ``max_docs`` documents of one host hold."""
    return rows.groupBy("line").agg(F.countDistinct("row_key").alias("docs")).filter(F.col("docs") > max_docs)


def words_removed(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Per row_key the words in lines, and those in lines above the limit.

    A row repeated m times has m times both figures; their ratio is right.
    """
    # Read twice: written down as three numbers a line.
    rows = staged(line_rows(docs), "line-rows")
    frequent = staged(frequent_lines(rows, max_docs).select(F.col("line").alias("above")), "lines")
    marked = rows.join(frequent, F.col("line") == F.col("above"), "left")
    gone = F.sum(F.when(F.col("above").isNotNull(), F.col("n")).otherwise(0))
    return marked.groupBy("row_key").agg(F.sum("n").alias("all_words"), gone.alias("gone_words"))


def quality_rules(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The base figures, the words that frequent lines take away, and ``kept``, for every row."""
    removed = words_removed(docs, max_docs)
    rows = base_figures(docs).join(removed, "row_key", "left")
    gone = F.coalesce(F.col("gone_words") * F.col("n_words") / F.col("all_words"), F.lit(0)).cast("long")
    rows = rows.withColumn("n_removed_words", gone)
    depleted = F.col("n_words") - F.col("n_removed_words") < F.lit(min_left) * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def without_frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``; all rows and columns stay."""
    rows = line_rows(docs)
    frequent = staged(frequent_lines(rows, max_docs).select(F.col("line").alias("above")), "lines")
    bad = rows.join(frequent, F.col("line") == F.col("above")).groupBy("row_key").agg(F.collect_set("line").alias("bad"))
    names = docs.columns
    keyed = docs.select(F.struct("*").alias("__row"), F.xxhash64("doc_id", "source", "text").alias("row_key"))
    keyed = keyed.join(bad, "row_key", "left")
    row = F.col("__row")
    left = F.filter(F.split(row.getField("text"), "\n"), lambda x: ~F.array_contains("bad", line_key(x, row.getField("source"))))
    text = F.when(F.col("bad").isNull(), row.getField("text")).otherwise(F.array_join(left, "\n"))
    return keyed.select(*[(text if c == "text" else row.getField(c)).alias(c) for c in names])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM docs WHERE len(w) >= 3)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), lines AS (
  SELECT r, doc_id, source, line,
         trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), frequent AS (
  SELECT source, plain FROM lines GROUP BY source, plain HAVING count(DISTINCT r) > {MAX_DOCS}
), per AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN f.plain IS NOT NULL THEN n ELSE 0 END) AS gone
  FROM lines l LEFT JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.plain = f.plain GROUP BY r
), figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone, 0) AS BIGINT) AS n_removed_words
  FROM docs LEFT JOIN per USING (r) LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND NOT (n_words - n_removed_words < {MIN_LEFT} * n_words) AS kept FROM judged
"""
