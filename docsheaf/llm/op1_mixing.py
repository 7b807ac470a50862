"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight, but never more than
``epochs`` passes over what it has. What a full source cannot take is dealt to
the others by weight, until no source is above its limit. That end state has a
closed form: with the sources ordered by limit over weight there is one level
L with ``target = min(limit, L * weight)``, found from running sums.

A source with ``target / size = 1.3`` takes every document once and a seeded
30 % of its words a second time. Documents are ordered by a hash of seed and
id; the extra ones are those below a cut, placed where the words below it come
nearest to what is asked. The cut is found in two steps, so that no task needs
a whole source: words per hash bin, then the documents of one bin only.

Cases: a null text and a text without words have size 0 and are taken with 0
words. A null source is a source, last in order. Rows with the same id are
decided alike. An empty table gives an empty result. A source without words
has target 0. Further columns of the input are ignored (``mix_plan``) or kept
(``mixed``), whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import staged, table, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
# A bin is the first three hex digits of the hash.
HEX, BIN_HEX = 12, 3


def place(doc_id: Column, seed: str) -> Column:
    """Where a document stands in its source: 48 bits of a seeded hash."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, HEX), 16, 10).cast("long")


def cycled_weights(sources: DataFrame, cycle: Sequence[float] = WEIGHTS) -> DataFrame:
    """Weights repeated over the sources in code point order, null last.

    One row per source goes through one task here: names and sums only.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", "source_size", F.get(values, order % len(cycle)).alias("weight"))


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight)."""
    limit = F.col("source_size") * F.lit(float(epochs))
    rows = sources.select("*", limit.alias("limit"), (limit / F.col("weight")).alias("fills_at"))
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", (
        F.sum("source_size").over(everywhere) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(from_here))
    # The first source that the level does not fill sets it; if all fill, each has its limit.
    level = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "source", "level"))).over(everywhere)
    rows = rows.withColumn("level", level.getField("level"))
    target = F.least(F.col("limit"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix_plan(sized: DataFrame, weigh=cycled_weights, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """One row per source of ``sized`` (source, size, place): what to take of it.

    ``whole`` passes over all its documents, and once more those whose place
    is at most ``cut`` (null: none).
    """
    span = 16 ** (HEX - BIN_HEX)
    bins = sized.groupBy("source", F.floor(F.col("place") / span).alias("bin")).agg(F.sum("size").alias("size"))
    sources = bins.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(weigh(sources), share, epochs).select(F.col("source").alias("s"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    filled = filled.withColumn("whole", whole.cast("long")).withColumn(
        "need", F.col("target") - F.col("whole") * F.col("source_size"))
    by_bin = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    running = bins.withColumn("before", F.coalesce(F.sum("size").over(by_bin), F.lit(0)))
    running = running.join(filled, F.col("source").eqNullSafe(F.col("s")))
    # The edge is the last bin that begins at or below the need; all bins before it are wholly taken.
    edge = running.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("whole").alias("whole"), F.first("need").alias("need"),
        F.max(F.when(F.col("before") <= F.col("need"), F.struct("bin", "before"))).alias("edge"))
    # One row per source: written down, so that joins with the documents see its size.
    edge = staged(edge, "mix-edge")
    edges = edge.select(F.col("source").alias("s"), "need", F.col("edge.bin").alias("edge_bin"), F.col("edge.before").alias("edge_before"))
    inside = sized.join(edges, F.col("source").eqNullSafe(F.col("s")) & (F.floor(F.col("place") / span) == F.col("edge_bin")))
    # Rows of one place are taken together: the frame counts peers as one.
    places = inside.groupBy("source", "place").agg(F.sum("size").alias("size"), F.first("need").alias("need"), F.first("edge_before").alias("edge_before"))
    along = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("edge_before") + F.coalesce(F.sum("size").over(along), F.lit(0)) + F.col("size") / 2
    cuts = places.withColumn("middle", middle).filter(F.col("middle") <= F.col("need")).groupBy(
        F.col("source").alias("c")).agg(F.max("place").alias("last"))
    plan = edge.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left")
    cut = F.coalesce(F.col("last"), F.col("edge.bin") * span - 1)
    return staged(plan.select("source", "source_size", "target", "whole", F.when(F.col("need") > 0, cut).alias("cut")), "mix-plan")


def sized_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place(F.col("doc_id"), seed).alias("place"))


def copies(epochs: float = EPOCHS) -> Column:
    """How often a document is taken, from the columns of ``mix_plan`` and ``place``."""
    extra = F.coalesce(F.col("place") <= F.col("cut"), F.lit(False)).cast("long")
    return F.least(F.col("whole") + extra, F.lit(int(epochs)))


def mix_sources(docs: DataFrame, weigh=cycled_weights, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    ``weigh`` gives (source, source_size, weight) for (source, source_size).
    """
    sized = staged(sized_documents(docs, seed), "mix")
    plan = mix_plan(sized, weigh, share, epochs).withColumnRenamed("source", "plan_source")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left").withColumn("copies", copies(epochs))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weigh=cycled_weights, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    names = docs.columns
    plan = mix_plan(staged(sized_documents(docs, seed).drop("doc_id"), "mix"), weigh, share, epochs)
    plan = plan.select(F.struct("*").alias("__plan"))
    rows = docs.select(F.struct("*").alias("__row"), place(F.col("doc_id"), seed).alias("place"))
    rows = rows.join(plan, F.col("__row.source").eqNullSafe(F.col("__plan.source")), "left")
    rows = rows.select("__row", "place", F.col("__plan.whole").alias("whole"), F.col("__plan.cut").alias("cut"))
    times = F.when(copies(epochs) > 0, F.sequence(F.lit(1), copies(epochs).cast("int"))).otherwise(F.array().cast(T.ArrayType(T.IntegerType())))
    return rows.select("__row", F.explode(times)).select(*[F.col("__row").getField(c).alias(c) for c in names])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, {HEX})) AS BIGINT) AS place
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         source_size * {EPOCHS}::DOUBLE AS lim FROM sums
), levels AS (
  SELECT *, lim / weight AS fills_at,
         ((SELECT sum(source_size) FROM sums) * {SHARE}::DOUBLE
          - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), filled AS (
  SELECT source, source_size, least(lim, weight * (
    SELECT level FROM levels WHERE level <= fills_at ORDER BY fills_at, source NULLS LAST LIMIT 1)) AS target FROM levels
), plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM filled
), placed AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS need,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
), taken AS (
  SELECT *, least(whole + CASE WHEN need > 0 AND before + size / 2.0 <= need THEN 1 ELSE 0 END, {EPOCHS}) AS copies FROM placed
)
SELECT doc_id, source, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken FROM taken
"""
