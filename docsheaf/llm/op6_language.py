"""Language identification by sparse multinomial logistic regression.

A text becomes TF-IDF weights of hashed character 1-, 2- and 3-grams over its
letters (case folded, everything else one space). The regression is trained
with follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalty),
so that most weights are exactly zero, and a temperature fitted on rows kept
aside makes its probabilities honest.

Document frequencies come from all texts that may be learned from. The
regression itself is fitted on a bounded sample: ``PER_LANGUAGE`` texts of each
language, chosen by a hash of their id. Prediction reads every whole text where
it lies; only the weights (languages x buckets) are sent to the tasks.

Cases: null texts and texts without a letter are ``und`` with score 0. Rows
without a language are predicted, not learned from. If nothing can be learned
every text is ``und``. Equal probabilities go to the first language in order. A
null id counts as an empty one. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_before, as_text, objects, small_batches, table

BITS = 15
ORDERS = 3
PER_LANGUAGE = 800
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None, bits: int = BITS) -> np.ndarray | None:
    """Buckets of all n-grams of a text in any order; None without a letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    plain = np.where(letter, codes, 32).astype(np.uint32)
    space = ~letter
    plain = plain[~(space & np.concatenate(([False], space[:-1])))].astype(np.uint64)
    state, out = np.zeros(len(plain), np.uint64), []
    for n in range(1, ORDERS + 1):
        state = (state[: len(plain) - n + 1] * np.uint64(0x100000001B3)) ^ plain[n - 1:]
        mixed = (state + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        if len(plain) <= n:
            break
    return np.concatenate(out)


def term_counts(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets present in a text and how often."""
    found = grams(text, bits)
    if found is None:
        return None
    counts = np.bincount(found, minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weights_of(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[at]
    return values / np.sqrt((values * values).sum())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


class Leader:
    """Follow the regularised leader over (language, bucket) weights."""

    def __init__(self, languages: int, size: int) -> None:
        self.z = np.zeros((languages, size))
        self.n = np.zeros((languages, size))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, language: int) -> None:
        w = self.weights(at)
        off = softmax(w @ x)
        off[language] -= 1.0
        g = np.outer(off, x)
        n = self.n[:, at]
        after = n + g * g
        self.z[:, at] += g - (np.sqrt(after) - np.sqrt(n)) / ALPHA * w
        self.n[:, at] = after


def fitted_temperature(logits: list[np.ndarray], truth: list[int]) -> float:
    """The temperature with the least loss on rows kept aside, by golden section."""
    if not logits:
        return 1.0
    z, y = np.array(logits), np.array(truth)

    def loss(log_t: float) -> float:
        s = z / np.exp(log_t)
        s -= s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, golden = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int = BITS

    def predict(self, text: str | None) -> tuple[str, float]:
        found = term_counts(text, self.bits) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        at, counts = found
        p = softmax(self.weights[:, at] @ weights_of(at, counts, self.idf) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def document_frequencies(texts: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are.

    Every task sends one row per bucket at most, summed in Spark.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, texts = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if (found := term_counts(text, bits)) is not None:
                    seen[found[0]] += 1
                    texts += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(seen[at], texts)})

    rows = texts.select("text").mapInPandas(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    out = np.zeros(1 << bits)
    inside = rows["bucket"] >= 0
    out[rows["bucket"][inside]] = rows["n"][inside]
    return out, int(rows["n"][~inside].sum())


def sampled(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, by a hash of id and text.

    Languages with fewer rows are taken whole. The number of rows is bounded by
    that of languages, as hash values spread evenly.
    """
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, int(min(1.0, per_language / n) * 1_000_000)).otherwise(share)
    return labelled.filter(place < share)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, bits: int = BITS) -> Model:
    """Fit on the rows of ``docs`` that are not held out and have a language."""
    small_batches(docs.sparkSession)
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    frequency, texts = document_frequencies(labelled, bits)
    idf = np.log((1.0 + texts) / (1.0 + frequency)) + 1.0

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [term_counts(t, bits) for t in batch["text"]]
            keep = [f is not None for f in found]
            yield pd.DataFrame({
                "place": batch["place"][keep].to_numpy(), "lang": batch["lang"][keep].to_numpy(),
                "at": objects([f[0].astype(np.int32) for f in found if f is not None]),
                "counts": objects([f[1].astype(np.int32) for f in found if f is not None])})

    rows = sampled(labelled, per_language).select(F.xxhash64(F.lit("order"), "doc_id", "text").alias("place"), "text", "lang")
    rows = rows.mapInPandas(count, "place bigint, lang string, at array<int>, counts array<int>").toArrow().to_pandas().sort_values("place", kind="stable")
    languages = sorted(rows["lang"].unique())
    truth = [languages.index(x) for x in rows["lang"]]
    vectors = [(at, weights_of(at, c, idf)) for at, c in zip(rows["at"], rows["counts"])]
    leader = Leader(len(languages), 1 << bits)
    # Every fifth row is kept aside for the temperature.
    for _ in range(EPOCHS):
        for i, (at, x) in enumerate(vectors):
            if i % 5:
                leader.learn(at, x, truth[i])
    weights = leader.weights()
    aside = range(0, len(vectors), 5)
    temperature = fitted_temperature([weights[:, vectors[i][0]] @ vectors[i][1] for i in aside], [truth[i] for i in aside])
    return Model(languages, idf, weights.astype(np.float32), temperature, bits)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; only the text is looked at."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"],
                                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    rows = as_text(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), "doc_id")
    return as_before(rows.mapInPandas(predict, "doc_id string, held_out boolean, lang_pred string, score double"), docs, "doc_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
