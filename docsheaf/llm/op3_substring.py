"""Substring dedup by sliding sentence spans.

A text is cut into sentences (at line ends, and after . ! ? before white
space). From every sentence a span runs on, and to every sentence a span runs
back, each the shortest run of at least two consecutive sentences with at least
``MIN_WORDS`` words; a sentence of at least ``ALONE`` words is a span by itself
as well. A passage of whole sentences with that many words is thus covered by
spans that lie inside it, wherever it stands; of a passage that begins or ends
in mid-sentence, the whole sentences inside it are. Spans are hashed over their
normalised text (case and white space), and joined globally; sentences covered
by any span that is not the first of its kind go. First is the smallest
(doc_id, place), ids in order, null last.

Only hashes of spans that occur more than once are joined; counting them sums
in the tasks first, and the repeated ones are written down, so that a passage
that a third of all documents share is split or broadcast, never gathered. The
spans of one document are all that is ever brought together.

Cases: a null text stays null; an empty one, or one with less than
``MIN_WORDS`` words, stays as it is. A text all of whose sentences go becomes
empty. Rows repeated in full, and equal texts of one id, count as one
occurrence and get the same text. Removal joins what is left: the white space
in front of a removed sentence goes with it. Further columns are kept.
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

# Far below the 50 words of a passage to catch, as it may begin and end in mid-sentence.
MIN_WORDS = 15
# Words from which one sentence is a span; shorter ones recur by themselves.
ALONE = 20
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)|(?=\n)|\Z)", re.S)


def sentences(text: str) -> list[tuple[int, int]]:
    """Begin and end of every sentence that has a word; the white space between is in none."""
    out, at = [], 0
    while at < len(text):
        end = _SENTENCE.match(text, at).end()
        if end == at:
            at += 1
            continue
        piece = text[at:end]
        if plain := piece.strip():
            begin = at + len(piece) - len(piece.lstrip())
            out.append((begin, begin + len(plain)))
        at = end
    return out


def spans(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(hash, first, last) of every span of a text, sentences counted from 0."""
    found = sentences(text)
    plain = [" ".join(text[b:e].lower().split()) for b, e in found]
    ends = np.concatenate(([0], np.cumsum([p.count(" ") + 1 for p in plain]))).astype(np.int64)
    n = len(plain)
    if not n or ends[n] < min_words:
        return []
    # The span from i ends before on[i].
    on = np.maximum(np.searchsorted(ends, ends[:n] + min_words), np.arange(n) + 2)
    back = np.minimum(np.searchsorted(ends, ends[1:] - min_words, side="right"), np.arange(n)) - 1
    runs = {(i, int(on[i]) - 1) for i in range(n) if on[i] <= n}
    runs |= {(int(back[j]), j) for j in range(n) if back[j] >= 0}
    runs |= {(i, i) for i in np.flatnonzero(np.diff(ends) >= max(ALONE, min_words)).tolist()}
    digests = [xxhash.xxh64_digest(p.encode("utf-8", "replace")) for p in plain]
    out = []
    for first, last in sorted(runs):
        value = xxhash.xxh64_intdigest(b"".join(digests[first:last + 1]))
        out.append((value - (1 << 64) if value >= 1 << 63 else value, first, last))
    return out


def without(text: str, covered: set[int]) -> str:
    """A text without the sentences of these numbers."""
    kept, at = [], 0
    for i, (begin, end) in enumerate(sentences(text)):
        if i not in covered:
            kept.append(text[at:end])
        at = end
    if not kept:
        return ""
    out = "".join(kept) + text[at:]
    return out.strip() if 0 in covered else out


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def span_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, row_key, hashes, ranges) per row that has spans; a range is first * 2**32 + last."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [spans(t, min_words) if t else [] for t in batch["text"]]
            have = [bool(f) for f in found]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"][have].to_numpy(), "row_key": batch["row_key"][have].to_numpy(),
                "hashes": objects([np.array([h for h, _, _ in f], np.int64) for f in found if f]),
                "ranges": objects([np.array([a << 32 | b for _, a, b in f], np.int64) for f in found if f])})

    rows = as_text(docs.select(row_key().alias("row_key"), "doc_id", "text"), "doc_id")
    return as_before(rows.mapInPandas(read, "doc_id string, row_key bigint, hashes array<bigint>, ranges array<bigint>"), docs, "doc_id")


def repeated_ranges(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row_key, ranges): the sentence ranges of a row that repeat an earlier span."""
    rows = staged(span_rows(docs, min_words), "spans")
    counts = rows.select(F.explode("hashes").alias("hash")).groupBy("hash").count()
    again = staged(counts.filter(F.col("count") > 1).select(F.col("hash").alias("h")), "repeated")
    each = rows.select("doc_id", "row_key", F.explode(F.arrays_zip("hashes", "ranges")).alias("x")).select(
        "doc_id", "row_key", F.col("x.hashes").alias("hash"), F.col("x.ranges").alias("range"))
    hits = staged(each.join(again, F.col("hash") == F.col("h"), "left_semi"), "hits")
    # Null ids come last: false sorts before true.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "range", "row_key")
    first = staged(hits.groupBy("hash").agg(F.min(place).alias("first")).select("first"), "first")
    # Both sides by text: the last join has a row for each text with repeated spans, not for each span.
    found = hits.groupBy("row_key").agg(F.collect_set("range").alias("all"))
    own = first.groupBy(F.col("first.row_key").alias("k")).agg(F.collect_set("first.range").alias("own"))
    later = found.join(own.hint("merge"), F.col("row_key") == F.col("k"), "left").select(
        "row_key", F.array_except("all", F.coalesce("own", F.array().cast("array<bigint>"))).alias("ranges"))
    return later.filter(F.size("ranges") > 0)


def cut(text: pd.Series, ranges: pd.Series) -> pd.DataFrame:
    texts, counts = [], []
    for t, found in zip(text, ranges):
        covered = {i for r in map(int, found) for i in range(r >> 32, (r & 0xFFFFFFFF) + 1)}
        texts.append(without(t, covered) if covered else t)
        counts.append(len(covered))
    return pd.DataFrame({"text": objects(texts), "n_removed": counts})


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated sentences taken out of ``text``, and ``n_removed`` of them at the end."""
    small_batches(docs.sparkSession)
    found = staged(repeated_ranges(docs, min_words), "ranges").select(F.col("row_key").alias("__found"), F.col("ranges").alias("__ranges"))
    names = [c for c in docs.columns if c != "n_removed"]
    rows = docs.select(F.struct(*names).alias("__row"), row_key().alias("__key"))
    # What is found grows with the corpus: never broadcast, so the plan is the same at every size.
    rows = rows.join(found.hint("merge"), F.col("__key") == F.col("__found"), "left")
    cutter = F.pandas_udf(cut, "text string, n_removed bigint")
    rows = rows.withColumn("__new", cutter(
        F.when(F.col("__ranges").isNotNull(), F.col("__row.text")), F.coalesce("__ranges", F.array().cast("array<bigint>"))))
    text = F.when(F.col("__ranges").isNull(), F.col("__row.text")).otherwise(F.col("__new.text"))
    return rows.select(*[(text if c == "text" else F.col("__row").getField(c)).alias(c) for c in names], F.col("__new.n_removed").alias("n_removed"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")
