"""The corpus pipeline: documents in, a clean and mixed training corpus out.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame. ``run`` writes
every stage's result as Parquet in the shared folder and reads it back for the
next, so that lost executors never cost more than one stage. All stages keep
the columns of ``documents``, whatever else the table holds; the last repeats
documents as the mix asks and adds none.

Cases: rows repeated in full leave the near-copy stage once; null and empty
texts pass the filters (no stage has a reason to reject them); an empty table
stays empty. A document all of whose sentences repeat earlier ones goes, as
nothing of it is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsheaf.llm.common import staged, table
from docsheaf.llm.op1_mixing import mixed
from docsheaf.llm.op2_decontaminate import decontaminated
from docsheaf.llm.op3_substring import without_repeats
from docsheaf.llm.op4_classifier import resampled
from docsheaf.llm.op5_jaccard import without_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return resampled(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that repeat; ``n_chars`` follows the text."""
    names = docs.columns
    rows = without_repeats(docs)
    left = rows.filter((F.col("n_removed") == 0) | F.col("n_removed").isNull() | (F.col("text") != ""))
    if "n_chars" in names:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_spans),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
]

# The classifier is a sampled statistical model: SQL cannot state it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
