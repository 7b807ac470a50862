"""Stretches of a text that repeat with a fixed period, by block convolution.

A run is a stretch of consecutive words in which words ``period`` apart are the
same, at least ``times`` periods and ``min_length`` words long, which no
neighbouring word extends, and whose period is the smallest it has.

For every dyadic scale B the text is cut into blocks of B words. A run whose
period lies in [B, 2B) and that is four periods long holds a whole block
together with its next copy, so some block of it occurs without a mismatch at
just that distance in the window behind it. All distances of all blocks of a
scale are tried at once: the sum of squared differences of a block and its
window, at each distance, is a convolution, taken by a number-theoretic
transform. Words are small numbers, so that no sum reaches the modulus and a sum
is zero only if all differences are. Distances found are seeds, which are
checked on the words themselves and extended both ways to their mismatches.

Blocks go untried only where nothing can be found: if one of their words has no
equal within 2B words, or if they lie with their window inside a run of a
smaller period, in which every match repeats that period.

Each text is worked on by itself; nothing is shuffled.

Cases: a null text has no words. A null id is carried along, and its text is
left as it is by the query's planting. Repeated rows get the same result each.
Texts of any length are searched whole, in pieces of bounded memory. Columns of
any other name are kept by ``collapsed`` and ignored otherwise. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_sql, small_batches, table

MIN_LENGTH = 6
TIMES = 4
PRIME, ROOT = 998244353, 3  # 119 * 2**23 + 1 and a generator of its units
VALUES = 256
CELLS = 1 << 19
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FACTORS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def factors(half: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a root of unity of order ``2 * half``, and of its inverse."""
    if half not in _FACTORS:
        out = []
        for root in (pow(ROOT, (PRIME - 1) // (2 * half), PRIME), pow(ROOT, PRIME - 1 - (PRIME - 1) // (2 * half), PRIME)):
            powers = np.ones(1, np.uint64)
            while len(powers) < half:  # doubling: the upper half is the lower one times a power
                powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), PRIME)) % PRIME])
            out.append(powers)
        _FACTORS[half] = out[0], out[1]
    return _FACTORS[half]


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, of a length that is a power of two; frequencies in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([(low + high) % PRIME, (low + PRIME - high) * factors(half)[0] % PRIME], 2)
        half //= 2
    return rows.reshape(count, size)


def inverse(rows: np.ndarray) -> np.ndarray:
    """Back from ``transform``."""
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * factors(half)[1] % PRIME
        rows = np.stack([(low + high) % PRIME, (low + PRIME - high) % PRIME], 2)
        half *= 2
    return rows.reshape(count, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences of each block and its window, at all of the block's places in the window.

    Blocks have B numbers, windows 2B - 1, so there are B places. Exact while B
    times the square of the greatest number is below the modulus.
    """
    count, size = blocks.shape
    spread = np.zeros((2, count, 2 * size), np.uint64)
    spread[0, :, :size] = blocks[:, ::-1]
    spread[1, :, :-1] = windows
    product = transform(spread[0]) * transform(spread[1]) % PRIME
    # What wraps around falls below place size - 1.
    products = inverse(product)[:, size - 1:2 * size - 1].astype(np.int64)
    squares = np.concatenate([np.zeros((count, 1), np.int64), np.cumsum(windows.astype(np.int64) ** 2, 1)], 1)
    own = (blocks.astype(np.int64) ** 2).sum(1, keepdims=True)
    return own + squares[:, size:] - squares[:, :-size] - 2 * products


def next_equal(ids: np.ndarray) -> np.ndarray:
    """For each place the distance to the next place with the same number; the length if there is none."""
    out = np.full(len(ids), len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


class Known:
    """Runs found so far, to tell whether one holds a given stretch."""

    def __init__(self) -> None:
        self.runs: dict[tuple[int, int], int] = {}
        self._sorted = None

    def add(self, start: int, length: int, period: int) -> None:
        if period < self.runs.get((start, length), period + 1):
            self.runs[start, length] = period
            self._sorted = None

    def around(self, starts: np.ndarray, ends: np.ndarray, distances: np.ndarray | None = None) -> np.ndarray:
        """Whether the run that reaches furthest from at or before each start holds the stretch, and its period divides the distance."""
        if not self.runs:
            return np.zeros(len(starts), bool)
        if self._sorted is None:
            rows = np.array([(s, s + n, p) for (s, n), p in sorted(self.runs.items())], np.int64)
            best = np.maximum.accumulate(rows[:, 1])
            reach = np.maximum.accumulate(np.where(rows[:, 1] == best, np.arange(len(rows)), 0))
            self._sorted = rows[:, 0], rows[reach, 1], rows[reach, 2]
        begins, reached, periods = self._sorted
        at = np.searchsorted(begins, starts, "right") - 1
        held = (at >= 0) & (reached[at] >= ends)
        return held if distances is None else held & (distances % periods[at] == 0)


def seeds(ids: np.ndarray, near: np.ndarray, size: int, known: Known, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, distances): blocks of ``size`` words that occur again ``size`` to ``2 * size - 1`` words on."""
    n = len(ids)
    count = n // size
    starts = np.flatnonzero(near[:count * size].reshape(count, size).max(1) < 2 * size) * size
    starts = starts[starts + 2 * size <= n]
    if len(starts):
        starts = starts[~known.around(starts, np.minimum(starts + 3 * size - 1, n))]
    if not len(starts):
        return starts, starts
    values = min(VALUES, int((PRIME // size) ** 0.5))
    numbers = np.concatenate([ids % values, np.zeros(2 * size, ids.dtype)]).astype(np.uint64)
    found, each = [], max(1, CELLS // size)
    for k in range(0, len(starts), each):
        part = starts[k:k + each, None]
        zero = mismatches(numbers[part + np.arange(size)], numbers[part + size + np.arange(2 * size - 1)]) == 0
        row, place = np.nonzero(zero)
        found.append((part[row, 0], place + size))
    starts, distances = (np.concatenate(x) for x in zip(*found))
    fits = (starts + size + distances <= n) & (distances <= longest)
    starts, distances = starts[fits], distances[fits]
    fresh = ~known.around(starts, starts + size + distances, distances)
    return starts[fresh], distances[fresh]


def agreeing(ids: np.ndarray, start: int, distance: int, back: bool) -> int:
    """How many places on from ``start`` (or back from before it) equal those ``distance`` further on."""
    done, step = 0, 64
    room = start if back else len(ids) - distance - start
    while done < room:
        step = min(step, room - done)
        low = start - done - step if back else start + done
        same = ids[low:low + step] == ids[low + distance:low + distance + step]
        if back:
            same = same[::-1]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + step, step * 2
    return done


def runs(ids: np.ndarray, min_length: int = MIN_LENGTH, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period. ``times`` is at least four."""
    n, known = len(ids), Known()
    longest = n // times
    near = next_equal(ids)
    size = 1
    while size <= longest and n >= min_length:
        starts, distances = seeds(ids, near, size, known, longest)
        order = np.lexsort((starts, distances))
        starts, distances = starts[order], distances[order]
        for distance in np.unique(distances).tolist():
            at, end = np.searchsorted(distances, [distance, distance + 1])
            while at < end:
                start = int(starts[at])
                ahead = agreeing(ids, start, distance, False)
                if ahead < size:  # folded numbers agreed, the words do not
                    at += 1
                    continue
                first = start - agreeing(ids, start, distance, True)
                length = start + ahead + distance - first
                if length >= max(min_length, times * distance):
                    known.add(first, length, distance)
                at += max(1, int(np.searchsorted(starts[at:end], start + ahead)))
        size *= 2
    return sorted(((s, length, p) for (s, length), p in known.runs.items()), key=lambda r: (r[0], r[2]))


def numbered(words: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def kept_words(words: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds behind its first period."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, depth in zip(words, np.cumsum(edges).tolist()) if not depth]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic(docs: DataFrame, prepare: Callable[[list[str], int | None], list[str]] | None = None,
             min_length: int = MIN_LENGTH, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, collapsed) for every row: its runs, and its text with each run cut to one period.

    ``prepare`` may change the words of a text before they are searched.
    """
    small_batches(docs.sparkSession, 256)
    rows = docs.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, all_runs, texts = batch.column(0), [], []
            for key, text in zip(ids.to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text or "")
                if prepare:
                    words = prepare(words, key)
                found = runs(numbered(words), min_length, times)
                all_runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                texts.append(" ".join(kept_words(words, found)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(all_runs, kind), pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(search, schema)


def collapsed(docs: DataFrame, min_length: int = MIN_LENGTH, times: int = TIMES) -> DataFrame:
    """``docs`` with each run in ``text`` cut to its first period; texts without runs stay as they are."""
    small_batches(docs.sparkSession, 256)
    at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for k, text in enumerate(texts):
                words = _WORD.findall(text or "")
                found = runs(numbered(words), min_length, times)
                if found:
                    texts[k] = " ".join(kept_words(words, found))
            arrays = batch.columns
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(cut, docs.schema)


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The query's planting: in every tenth document by a hash, the words repeat from some place on."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic(table(spark, sf_dir, "documents"), planted)
    line = lambda r: F.concat_ws(",", *[r.getField(c).cast("string") for c in ("start", "length", "period")])
    text = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    # The greatest by length, then by small start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.getField("length").alias("length"), (-r.getField("start")).alias("start"), (-r.getField("period")).alias("period"))))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         coalesce({crc32_sql('CAST(doc_id AS VARCHAR)')}, 1) AS h FROM documents
), places AS (
  SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM docs
), planted AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w
  FROM (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM places)
), toks AS (
  SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM planted
), pairs AS (
  SELECT x.r, y.i - x.i AS q, x.i FROM toks x JOIN toks y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // {TIMES}
), islands AS (
  SELECT r, q, min(i) AS s, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
  GROUP BY r, q, island HAVING count(*) + q >= greatest({MIN_LENGTH}, {TIMES} * q)
), runs AS (
  SELECT r, s, length, min(q) AS q FROM islands GROUP BY r, s, length
), figures AS (
  SELECT r, count(*) AS n_runs, arg_min(s, (-length, s, q)) AS start, arg_min(length, (-length, s, q)) AS length,
         arg_min(q, (-length, s, q)) AS period, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS runs
  FROM runs GROUP BY r
), dropped AS (
  SELECT DISTINCT r, i FROM (SELECT r, unnest(range(s + q, s + length)) AS i FROM runs)
), kept AS (
  SELECT t.r, string_agg(word, ' ' ORDER BY t.i) AS text FROM toks t ANTI JOIN dropped d ON t.r = d.r AND t.i = d.i GROUP BY t.r
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM planted LEFT JOIN figures USING (r) LEFT JOIN kept USING (r)
"""
