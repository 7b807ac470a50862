"""Exact de-duplication with a heavy-hitter split, in DataFrame functions only.

Texts are equal when they are the same after each run of white space became one
space; their SHA-256 stands for them. Digests of which very many documents hold
copies would all meet in one task of a shuffle, so they are split off:

1. Misra-Gries counters find candidates. Spark's ``approx_top_k`` keeps them: a
   fixed number of digests with counts, all lowered together when the room is
   used up; counters of tasks add up, in two steps. Every digest that more than
   7 / 16,384 of all rows hold (twice the greatest error of the counters) is
   among the candidates, and there are never more than ``MOST``.
2. The candidates' rows are counted exactly, inside the tasks before a shuffle:
   one row for each digest, its winner. Candidates of a single row go.
3. The winners, at most ``MOST`` rows, are broadcast and settle all their copies
   without a shuffle. The other digests go through an ordinary shuffle, where a
   group is a small fixed share of all rows at most.

Which digests are split off changes no result, only where it is computed.

Cases: a null text is an empty one. A null ``doc_id`` is the greatest, so such a
row stays only if no copy has an id; ``keep_id`` is null then. Of rows that
repeat in full exactly one stays. Columns of any other name are carried by
``without_copies`` and ignored otherwise. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

TRACKED = 8192
MOST = 2500
MERGERS = 64
# What the rule replaces, less the single spaces, which it would replace by themselves.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text with runs of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " "), 256)


def short(digest: Column) -> Column:
    """The first 60 bits of a digest, as what the counters hold."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def rank_key(doc_id: Column, row: Column) -> Column:
    """Orders equal texts: by id, null last, then by the row's own number."""
    return F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("id"), row.alias("row"))


def candidates(rows: DataFrame, tracked: int = TRACKED, most: int = MOST) -> DataFrame:
    """(short): at most ``most`` digests, all very frequent ones among them."""
    counted = rows.select(short(F.col("digest")).alias("item"), (F.spark_partition_id() % MERGERS).alias("merger"))
    parts = counted.groupBy("merger").agg(F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("counters"))
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(counters, {tracked})").alias("counters"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(counters, {most})")).alias("found")).select(F.col("found.item").alias("short"))


def winners(rows: DataFrame, tracked: int = TRACKED, most: int = MOST) -> DataFrame:
    """(heavy, best, n): candidates with more than one row, counted exactly, and their first row."""
    few = F.broadcast(candidates(rows, tracked, most))
    found = rows.join(few, short(F.col("digest")) == F.col("short"), "left_semi")
    found = found.groupBy(F.col("digest").alias("heavy")).agg(
        F.min("place").alias("best"), F.count(F.lit(1)).alias("n"))
    return found.filter(F.col("n") > 1)


def copies(docs: DataFrame, tracked: int = TRACKED, most: int = MOST) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for every row of ``docs``."""
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
    # Numbers are drawn once, before the table is written.
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    rows = rows.select("digest", rank_key(F.col("doc_id"), F.col("row")).alias("place"))
    heavy = F.broadcast(staged(winners(rows, tracked, most), "winners"))
    settled = rows.join(heavy, F.col("digest") == F.col("heavy")).select("digest", "place", "best", "n")
    group = Window.partitionBy("digest")
    others = rows.join(heavy, F.col("digest") == F.col("heavy"), "left_anti").select(
        "digest", "place", F.min("place").over(group).alias("best"), F.count(F.lit(1)).over(group).alias("n"))
    return settled.unionAll(others).select(
        F.col("place.id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("place") == F.col("best")).alias("kept"), F.col("digest").alias("text_sha256"))


def without_copies(docs: DataFrame, tracked: int = TRACKED, most: int = MOST) -> DataFrame:
    """One row of ``docs`` for each distinct text, with all its columns.

    Rows that lose to a broadcast winner go inside their tasks; the rest is
    reduced there too before texts move. Of rows with one text and id, the least
    by a hash of all columns stays.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(row.alias("__row"), text_digest(F.col("text")).alias("__digest"))
    keyed = keyed.withColumn("__place", rank_key(F.col("__row").getField("doc_id"), F.xxhash64("__row")))
    rows = staged(keyed.select(F.col("__digest").alias("digest"), F.col("__place").alias("place")), "digests")
    heavy = F.broadcast(staged(winners(rows, tracked, most), "winners"))
    left = keyed.join(heavy, F.col("__digest") == F.col("heavy"), "left")
    left = left.filter(F.col("best").isNull() | (F.col("__place") == F.col("best")))
    kept = left.groupBy("__digest").agg(F.min_by("__row", "__place").alias("__row"))
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in names])


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents"))


SQL = r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM rows
"""
