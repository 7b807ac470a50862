"""Quality classifier by importance resampling.

Two generative models of hashed token n-grams are counted: one of the target
(texts labelled good) and one of the raw corpus, towards which the target model
is smoothed. A document's log importance is the mean over its n-grams of
log p_target - log p_raw, as for a text of ``LENGTH`` such n-grams: the plain sum
would weigh the length of a text, and the chance drift of rare words in long
ones, above what it is like. Adding seeded Gumbel noise and keeping the k
largest draws k documents without replacement in proportion to their importance.

k is set by the labels: the log importance that best parts good from bad
labelled texts is found, and k is the number of documents at or above it.

N-grams are single tokens and pairs of neighbours. A pair of equal tokens is
one feature of its own whatever the token, as repetition is a trait of a text.

The raw model counts all documents. The target model takes at most
``MAX_LABELS`` labelled rows, the first by a hash of their id; that bound makes
the broadcast of their ids safe. Each task sends one row per bucket at most.
The k-th largest score is found by counting in ever finer bins, not by sorting.

Cases: a null text, or one without tokens, has log importance 0. Without a good
label nothing is known, and all documents are kept. A document labelled twice
has its best label. Documents whose score ties with the k-th are all kept. Rows
with the same id get the same noise. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged, table
from .op1_mixing import HEX, place
from .tokens import TokenHashes, tokens

BUCKETS = 10_000
MAX_LABELS = 20_000
LENGTH = 200
# How much of the target model is the raw one, as a share of the target's n-grams.
PRIOR = 0.1
SEED = "gumbel-1"
# What the k-th largest is picked from once it is known to be among so few.
FEW = 10_000


def buckets_of(text: str | None, hashes: TokenHashes, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each n-gram of a text. Bucket 0 is for pairs of equal tokens."""
    h = hashes(tokens(text))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pairs = (pairs ^ (pairs >> np.uint64(29))) % np.uint64(buckets - 1) + np.uint64(1)
    pairs[h[:-1] == h[1:]] = 0
    return np.concatenate((h % np.uint64(buckets - 1) + np.uint64(1), pairs)).astype(np.int64)


def label_sample(labels: DataFrame, bound: int = MAX_LABELS) -> DataFrame:
    """(labelled_id, good) for at most ``bound`` labelled documents."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    first = known.select(F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("labelled_id"), "quality").orderBy("h", "labelled_id", "quality").limit(bound)
    return first.groupBy("labelled_id").agg((F.max("quality") > 0).alias("good"))


def log_ratios(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> np.ndarray | None:
    """log p_target - log p_raw per bucket; None without a good text."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, raw, good = TokenHashes(), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, is_good in zip(batch["text"], batch["good"]):
                counts = np.bincount(buckets_of(text, hashes, buckets), minlength=buckets)
                raw += counts
                if is_good:
                    good += counts
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "good": good[at]})

    # At most MAX_LABELS rows of two values.
    flagged = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id"), "left")
    rows = flagged.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInPandas(count, "bucket bigint, raw bigint, good bigint")
    sums = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow().to_pandas()
    raw, good = np.ones(buckets), np.zeros(buckets)
    raw[sums["bucket"]] += sums["raw"]
    good[sums["bucket"]] += sums["good"]
    if not good.any():
        return None
    raw /= raw.sum()
    return np.log((good / good.sum() + PRIOR * raw) / (1 + PRIOR)) - np.log(raw)


def importance(spark: SparkSession, ratios: np.ndarray) -> "callable":
    """A function of the text column to its log importance."""
    shared = spark.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes, known = TokenHashes(), shared.value
        for batch in batches:
            found = [buckets_of(t, hashes, len(known)) for t in batch]
            yield pd.Series([float(known[b].mean()) * LENGTH if len(b) else 0.0 for b in found], dtype="float64")

    return score


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    u = (place(doc_id, seed) + 0.5) / float(16 ** HEX)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column of numbers; None if there are fewer than k.

    Counts rows in 1,024 bins, then in the bin that holds the k-th, and so on;
    only counts come to the driver, and at last ``FEW`` values at most.
    """
    x = F.col(column)
    low, high, n = values.agg(F.min(x), F.max(x), F.count(x)).first()
    if k < 1 or k > n:
        return None
    while low < high:
        inside = values.filter((x >= low) & (x <= high))
        if n <= FEW:
            return sorted((r[0] for r in inside.select(x).collect()), reverse=True)[k - 1]
        # The double just above a bin's last value may fall into it: bounds are taken from the data.
        bins = F.least(F.floor((x - low) / (high - low) * 1024), F.lit(1023))
        for row in sorted(inside.groupBy(bins.alias("b")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).collect(), key=lambda r: -r["b"]):
            if k <= row["n"]:
                low, high, n = row["low"], row["high"], row["n"]
                break
            k -= row["n"]
    return low


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The score that parts good from bad with the least share of errors of both kinds."""
    if good.all() or not len(scores):
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost = np.concatenate(([0], np.cumsum(g))) / max(1, g.sum())
    passed = 1 - np.concatenate(([0], np.cumsum(~g))) / max(1, (~g).sum())
    at = int(np.argmin(lost + passed))
    if at == 0:
        return -np.inf
    return float((s[at - 1] + s[at]) / 2) if at < len(s) else float(np.nextafter(s[-1], np.inf))


def selection(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = MAX_LABELS, seed: str = SEED) -> tuple[DataFrame, "callable | None", float]:
    """The scored rows, the scoring function, and the k-th largest score.

    The rows are (doc_id, log_ratio, draw), written down once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = staged(label_sample(labels, bound), "labels")
    ratios = log_ratios(docs, sample, buckets)
    if ratios is None:
        return docs.select("doc_id", F.lit(0.0).alias("log_ratio"), gumbel(F.col("doc_id"), seed).alias("draw")), None, -np.inf
    score = importance(spark, ratios)
    rows = staged(docs.select("doc_id", score("text").alias("log_ratio")), "importance").withColumn(
        "draw", F.col("log_ratio") + gumbel(F.col("doc_id"), seed))
    labelled = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id")).groupBy("labelled_id").agg(
        F.first("log_ratio").alias("score"), F.first("good").alias("good")).select("score", "good").toArrow().to_pandas()
    cut = best_cut(labelled["score"].to_numpy(float), labelled["good"].to_numpy(bool))
    k = rows.filter(F.col("log_ratio") >= cut).count()
    edge = kth_largest(rows, "draw", k)
    return rows, score, np.inf if edge is None else edge


def resampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    _, score, edge = selection(docs, labels, **options)
    if score is None:
        return docs
    draw = score("text") + gumbel(F.col("doc_id"), options.get("seed", SEED))
    return docs.filter(draw >= F.lit(float(edge)))


def op4_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, edge = selection(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumn("kept", F.col("draw") >= F.lit(float(edge)))
