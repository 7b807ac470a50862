"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Texts and test items are words (letters and digits, case folded). Every
``LONG``-gram that a document shares with an item is a seed, and so are
``PAIR``-grams if there are enough of them: an item of L words with e words
replaced or left out scores (2 (L - e) - e) / 2L at best and keeps at least
L - 2e - 1 of its pairs, so every copy so edited that reaches the least score is
aligned. The part of the document around the seeds is aligned with the item word
by word; the best local score, as a share of that of a perfect copy, tells copies
and edited copies from chance. What has no seed are copies with words put in so
densely that no three words of the item stand together and few pairs do.

The documents are read once for n-grams that may be an item's: a bit field of
fixed size, made from the items in Spark, rejects nearly all others. Hits are
counted and joined in Spark; only documents that share seeds are aligned, each
with its items, in tasks, and only where the words that both hold stand close
enough together around the seeds, in the item and in the text, for the least score. A passage that a third of all documents share
gives each of them a row per item, split like any other.

Cases: null and empty texts match nothing. Items with fewer than ``N`` words are
too short to tell and match nothing; null items likewise. Equal items are all
reported. Rows repeated in full are reported as often as they occur in the
input. An empty table on either side gives an empty result. Further columns
are ignored by ``leaks`` and kept by ``decontaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_before, as_text, objects, small_batches, staged, table

N = 4
PAIR, LONG = 2, 3
FIELD_BITS = 22
# Share of the perfect score from which on a document counts as contaminated.
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"[^\W_]+")
_KNOWN_LIMIT, _KNOWN_ITEMS = 500_000, 10_000


class KnownWords(dict):
    """64-bit hashes of words, worked out when first asked for."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


class WordHashes:
    """The words of a text as 64-bit hashes; those met before are kept, up to a limit."""

    def __init__(self) -> None:
        self._known = KnownWords()

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self._known) > _KNOWN_LIMIT:
            self._known.clear()
        found = _WORD.findall(text.lower()) if text else []
        return np.fromiter(map(self._known.__getitem__, found), np.uint64, len(found))


def ngrams(words: np.ndarray, n: int = N) -> np.ndarray:
    """The hash of every n-gram, by its first word."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    state = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        state = (state ^ words[i: len(words) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(32)
    return state.view(np.int64)


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """The best local score of two sequences of words, and where in ``text`` it ends (exclusive).

    One row of the matrix at a time; a run of gaps along the row is a running
    maximum.
    """
    slope = -GAP * np.arange(len(text) + 1)
    above, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        row = np.maximum(0, above + GAP)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == word, MATCH, MISMATCH))
        above = np.maximum.accumulate(row + slope) - slope
        at = int(above.argmax())
        if above[at] > best:
            best, end = int(above[at]), at
    return best, end


def regions(hits: list[tuple[int, int]], size: int, length: int) -> list[tuple[int, int]]:
    """The stretches of a text of ``length`` words in which an item of ``size`` words with these (place, item place) hits may lie.

    An alignment that scores has at most ``size`` gaps before or behind a hit.
    """
    out: list[list[int]] = []
    for begin, end in sorted((max(0, p - q - size), min(length, p + 2 * size - q)) for p, q in hits):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def least_pairs(size: Column, min_score: float) -> Column:
    """The pairs that a copy with words replaced or left out keeps if it has the score."""
    return F.greatest(F.lit(1), F.ceil(size * ((4 * min_score - 1) / 3) - 1 - 1e-9))


def best_stretch(held: np.ndarray) -> int:
    """The most that a stretch of words can score if each held one matches and each other one costs the least."""
    sums = np.concatenate(([0], np.cumsum(np.where(held, MATCH, max(MISMATCH, GAP)))))
    return int((sums - np.minimum.accumulate(sums)).max())


class ItemWords:
    """The words of an item in order, and its distinct ones sorted."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.distinct, self.which = np.unique(words, return_inverse=True)

    def most_score(self, text: np.ndarray) -> float:
        """A bound of the score of a text: in the aligned stretch of either, a word that the other lacks is a mismatch or a gap."""
        at = np.minimum(np.searchsorted(self.distinct, text), len(self.distinct) - 1)
        held = self.distinct[at] == text
        there = np.zeros(len(self.distinct), bool)
        there[at[held]] = True
        return min(best_stretch(held), best_stretch(there[self.which])) / (MATCH * len(self.words))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def item_grams(items: DataFrame) -> DataFrame:
    """(item_id, size, n, at, hash) of every seed of every item of ``size`` words."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"]):
                words = hashes(text)
                for n in (PAIR, LONG) if len(words) >= N else ():
                    grams = ngrams(words, n)
                    yield pd.DataFrame({"item_id": objects([item] * len(grams)), "size": len(words), "n": n, "at": np.arange(len(grams)), "hash": grams})

    rows = as_text(items.select("item_id", "text"), "item_id").mapInPandas(read, "item_id string, size int, n int, at int, hash bigint")
    return as_before(rows, items, "item_id")


def bit_field(grams: DataFrame, bits: int = FIELD_BITS) -> np.ndarray:
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    rows = grams.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow().to_pandas()
    field = np.zeros(1 << (bits - 6), np.int64)
    field[rows["w"]] = rows["b"]
    return field


def hits(docs: DataFrame, field: np.ndarray) -> DataFrame:
    """(row_key, hashes, places) of the n-grams of each document that may be an item's."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, bits = WordHashes(), shared.value
        low = len(bits) * 64 - 1
        for batch in batches:
            keys, found, places = [], [], []
            for key, text in zip(batch["row_key"], batch["text"]):
                words = hashes(text)
                grams = np.concatenate([ngrams(words, n) for n in (PAIR, LONG)])
                slot = grams & low
                at = np.flatnonzero((bits[slot >> 6] >> (slot & 63)) & 1)
                if len(at):
                    keys.append(key)
                    found.append(grams[at])
                    pairs = max(0, len(words) - PAIR + 1)
                    places.append(np.where(at < pairs, at, at - pairs).astype(np.int32))
            yield pd.DataFrame({"row_key": keys, "hashes": objects(found), "places": objects(places)})

    return docs.select(row_key().alias("row_key"), "text").mapInPandas(read, "row_key bigint, hashes array<bigint>, places array<int>")


def seeded(found: DataFrame, grams: DataFrame, min_score: float) -> DataFrame:
    """(k, i, places) for the documents and items that share a long n-gram, or enough pairs."""
    each = found.select("row_key", F.explode(F.arrays_zip("hashes", "places")).alias("x")).select(
        "row_key", F.col("x.hashes").alias("h"), F.col("x.places").alias("place"))
    rows = each.join(grams, F.col("h") == F.col("hash")).groupBy("row_key", "item_id").agg(
        F.first("size").alias("size"), F.max("n").alias("longest"), F.collect_set(F.struct("place", "at")).alias("places"))
    pairs = F.size(F.array_distinct(F.col("places.at")))
    rows = rows.filter((F.col("longest") == LONG) | (pairs >= least_pairs(F.col("size"), min_score)))
    return rows.select(F.col("row_key").alias("k"), F.col("item_id").alias("i"), "places")


def holding(docs: DataFrame, field: np.ndarray) -> DataFrame:
    """(doc_id, row_key, text) of the rows whose key may be in a bit field: only those are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in batches:
            slot = batch["row_key"].to_numpy() & (len(bits) * 64 - 1)
            yield batch[(bits[slot >> 6] >> (slot & 63)) & 1 == 1]

    rows = as_text(docs.select("doc_id", row_key().alias("row_key"), "text"), "doc_id")
    return as_before(rows.mapInPandas(read, "doc_id string, row_key bigint, text string"), docs, "doc_id")


def leaks(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, row_key, item_id, score) for every document and item with at least that score."""
    small_batches(docs.sparkSession)
    grams = staged(item_grams(items), "grams")
    found = staged(hits(docs, bit_field(grams)), "hits")
    pairs = staged(seeded(found, grams, min_score), "pairs")
    near = holding(docs, bit_field(pairs.select(F.col("k").alias("hash"))))
    rows = near.join(pairs, F.col("row_key") == F.col("k"))
    rows = rows.join(items.select("item_id", F.col("text").alias("item_text")), F.col("i") == F.col("item_id"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, known, last, words = WordHashes(), {}, None, None
        for batch in batches:
            scores = []
            for key, text, item_text, places in zip(batch["row_key"], batch["text"], batch["item_text"], batch["places"]):
                # The items of a document follow each other.
                if key != last:
                    last, words = key, hashes(text)
                if len(known) > _KNOWN_ITEMS:
                    known.clear()
                if (item := known.get(item_text)) is None:
                    item = known[item_text] = ItemWords(hashes(item_text))
                size = len(item.words)
                near = [words[b:e] for b, e in regions([(x["place"], x["at"]) for x in places], size, len(words))]
                scores.append(max((align(w, item.words)[0] for w in near if item.most_score(w) >= min_score), default=-1) / (MATCH * size))
            out = batch[["doc_id", "row_key", "item_id"]].assign(score=scores)
            yield out[out["score"] >= min_score]

    rows = as_text(rows.select("doc_id", "row_key", "item_id", "text", "item_text", "places"), "doc_id", "item_id")
    scored = rows.mapInPandas(read, "doc_id string, row_key bigint, item_id string, score double")
    return as_before(as_before(scored, docs, "doc_id"), items, "item_id")


def decontaminated(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    bad = staged(leaks(docs, items, min_score).select(F.col("row_key").alias("__bad")).distinct(), "leaks")
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("__row"), row_key().alias("__key"))
    return rows.join(bad, F.col("__key") == F.col("__bad"), "left_anti").select(*[F.col("__row").getField(c).alias(c) for c in names])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")
