"""Language-model scoring by cross-entropy difference.

Two bigram models of the same kind are counted over one vocabulary: one of the
target (texts labelled good and not toxic), one of the background (a seeded
sample of all texts that matches the target in number, so that neither model
knows more than the other). Each token of a text loses -log2 p under each; the
mean loss per token under the target less that under the background scores the
text: the lower, the more it is like the target.

A text that a model counted is scored by that model without its own counts;
else a model would only remember its texts.

The vocabulary is every token of the corpus, and every pair that a model has
seen is counted: both are Spark tables that grow with the corpus, keyed by
64-bit hashes. A pair's probability mixes its count c with the probability of
its second token: p(b | a) = (c(a, b) + PRIOR p(b)) / (c(a) + PRIOR). The log of
this is a sum of a part of b, one of a and one of the pair, so a text's loss is
a base that holds for keys without counts, plus one term for each distinct key
of the text that has a count. Keys with at least 1/HOT of all counts, of which
there can be HOT at most, are broadcast and summed inside the task; the terms of
all other keys come from a join by key, and no key left to it is frequent. Bit
fields of fixed size spare the shuffle most keys that add nothing: those without
counts, and for a text that a model counted also pairs that no other counted text
holds. Where they fill up, they only let more through. Texts go through one
shuffle, for their labels, and are split once.

Cases: a null text, or one without tokens, has 0 tokens and null losses. With
no target (background) text that model is uniform over the vocabulary. A
document labelled twice is good if any label says so and none says toxic.
Repeated rows get the same scores. Losses are rounded to nine decimals, so that
the order of sums does not show. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import objects, small_batches, staged, table
from .op5_jaccard import bit_field, in_field
from .tokens import tokens

# The most keys whose counts are broadcast, 48 bytes each, and bits of the fields that tell which others have counts.
HOT, FIELD_BITS = 1 << 22, 26
# Weight of the single-token model in that of pairs, and the count added to every token.
PRIOR, ADDED = 20.0, 0.5
SEED = "background-1"
# Tokens that a task holds at once while it counts.
CHUNK = 2_000_000
_KNOWN_LIMIT = 500_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``staged``, whose shuffle files go with the write instead of waiting for the driver's garbage collection."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return staged(df, label)
    finally:
        conf.set(name, before)


class TokenKeys:
    """64-bit hashes of the tokens of a text; those met before are kept, up to a limit."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, out = self._known, []
        if len(known) > _KNOWN_LIMIT:
            known.clear()
        for token in tokens(text):
            value = known.get(token)
            if value is None:
                value = known[token] = xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace"))
            out.append(value)
        return np.array(out, np.uint64).view(np.int64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The key of each pair of neighbours, apart from those of tokens."""
    mixed = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def marked(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, text, target, background): which models count a row."""
    judged = labels.groupBy("doc_id").agg(F.max("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("x"))
    good = staged(judged.filter((F.col("q") > 0) & (F.col("x") == 0) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("good_id")), "good")
    n_good = docs.select("doc_id").join(good, F.col("doc_id") == F.col("good_id")).count()
    share = n_good / max(1, docs.count())
    # All 64 bits of the hash are compared, so that no share is too small for the sample.
    place = F.xxhash64(F.lit(seed), "doc_id").cast("double")
    rows = docs.select("text", "doc_id", (place < share * 2.0**64 - 2.0**63).alias("background"))
    # Labels grow with the corpus: never broadcast, so the plan is the same at every size.
    rows = rows.join(good.hint("merge"), F.col("doc_id") == F.col("good_id"), "left")
    return rows.select("doc_id", "text", F.col("good_id").isNotNull().alias("target"), F.coalesce("background", F.lit(False)).alias("background"))


def split(rows: DataFrame) -> DataFrame:
    """(row, doc_id, target, background, ids) of the rows of ``marked``, written; ids are the keys of the tokens in order."""
    small_batches(rows.sparkSession)

    @F.pandas_udf("array<bigint>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys = TokenKeys()
        for batch in texts:
            yield objects([keys(t) for t in batch])

    return written(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "target", "background", ids("text").alias("ids")), "split")


def counted(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, pair, second, x_target, x_background, y_target, y_background, texts) of all tokens and of the models' pairs.

    x is how often a model has seen the key, y how often a token stands before another.
    ``texts`` is how many counted texts hold a pair.
    """
    def sums(texts: list[np.ndarray], flags: list[tuple[bool, bool]]) -> pd.DataFrame:
        sizes = np.array([len(t) for t in texts])
        ids = np.concatenate(texts)
        seen = np.repeat(np.array(flags, np.float64), sizes, axis=0)
        before = np.ones(len(ids), bool)
        before[np.cumsum(sizes) - 1] = False
        keys, at = np.unique(ids, return_inverse=True)
        add = lambda where, weights, n: np.bincount(where, weights, n).astype(np.int64)
        single = pd.DataFrame({"key": keys, "pair": False, "second": np.int64(0), "texts": np.int64(0)})
        for model, name in enumerate(("target", "background")):
            single[f"x_{name}"] = add(at, seen[:, model], len(keys))
            single[f"y_{name}"] = add(at[before], seen[before, model], len(keys))
        first = np.flatnonzero(before & seen.any(axis=1))
        keys, place, at = np.unique(pair_keys(ids[first], ids[first + 1]), return_index=True, return_inverse=True)
        owner = np.repeat(np.arange(len(sizes)), sizes)[first]
        holders = np.bincount(np.unique(at * len(sizes) + owner) // len(sizes), minlength=len(keys))
        pairs = pd.DataFrame({"key": keys, "pair": True, "second": ids[first + 1][place], "texts": holders})
        for model, name in enumerate(("target", "background")):
            pairs[f"x_{name}"] = add(at, seen[first, model], len(keys))
            pairs[f"y_{name}"] = np.int64(0)
        return pd.concat([single, pairs], ignore_index=True)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, flags, held = [], [], 0
        for batch in batches:
            for ids, target, background in zip(batch["ids"], batch["target"], batch["background"]):
                if len(ids):
                    texts.append(np.asarray(ids, np.int64)); flags.append((target, background)); held += len(ids)
                if held > chunk:
                    yield sums(texts, flags)
                    texts, flags, held = [], [], 0
        if held:
            yield sums(texts, flags)

    numbers = [*(f"{v}_{m}" for m in ("target", "background") for v in "xy"), "texts"]
    found = rows.select("ids", "target", "background").mapInPandas(read, "key bigint, pair boolean, second bigint, " + ", ".join(f"{c} bigint" for c in numbers))
    return found.groupBy("key", "pair", "second").agg(*[F.sum(c).alias(c) for c in numbers])


@dataclass
class Models:
    """``rare`` is a table (rare_key, pair, x_…, y_…, texts) beside the ``hot`` keys; y of a pair is x of its second token.

    ``fields`` tell which rare keys matter to texts that no model counted, and to those that one did.
    """
    vocabulary: int
    totals: tuple[int, int]
    hot: pd.DataFrame
    rare: DataFrame
    fields: tuple[np.ndarray, np.ndarray]


def train(rows: DataFrame, hot: int = HOT, bits: int = FIELD_BITS) -> Models:
    """Both models over the rows of ``split``."""
    small_batches(rows.sparkSession)
    found = written(counted(rows), "counted")
    single = found.filter(~F.col("pair"))
    v, target, background = single.agg(F.count("*"), F.sum("x_target"), F.sum("x_background")).first()
    # Second tokens of many pairs lie on the left, where adaptive execution splits them.
    pairs = found.filter("pair").drop("y_target", "y_background").join(
        single.select(F.col("key").alias("of"), F.col("x_target").alias("y_target"), F.col("x_background").alias("y_background")).hint("merge"),
        F.col("second") == F.col("of"))
    names = ["key", "pair", "x_target", "y_target", "x_background", "y_background", "texts"]
    # Every y above 0 comes with an x above 0.
    model = written(single.filter((F.col("x_target") > 0) | (F.col("x_background") > 0)).select(names).union(pairs.select(names)), "model")
    totals = (target or 0, background or 0)
    # The counts of tokens and of pairs add up to twice the totals at most, so at most ``hot`` keys hold this share.
    frequent = (F.col("x_target") + F.col("x_background")) * hot >= 2 * sum(totals)
    top = model.filter(frequent).drop("texts").toArrow().to_pandas().sort_values("key", ignore_index=True)
    rare = model.filter(~frequent).withColumnRenamed("key", "rare_key")
    field = lambda found: bit_field(found.select(F.col("rare_key").alias("token")), bits)
    return Models(v, totals, top, rare, (field(rare), field(rare.filter(~F.col("pair") | (F.col("texts") > 1)))))


def places(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands among the sorted ``known`` ones; -1 if it does not."""
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def terms(lib, pair, m, before, x, y, scale):
    """What a key adds to the loss of a text over the base, for numpy as ``lib`` or Spark's functions.

    The text holds a token m times, ``before`` times before another; of a pair, ``before``
    is how often the text holds the second token. The model's counts x and y are without the text's.
    """
    single = before * lib.log2((y + PRIOR) / PRIOR) - m * lib.log2((x + ADDED) / ADDED)
    both = -m * lib.log2(1 + x * scale / (PRIOR * (y + ADDED)))
    return np.where(pair, both, single) if lib is np else F.when(pair, both).otherwise(single)


def own_keys(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of a text, tokens and pairs, with m and ``before`` as in ``terms``."""
    single, at, m = np.unique(ids, return_inverse=True, return_counts=True)
    before = m.copy()
    before[at[-1]] -= 1
    pairs, place, n = np.unique(pair_keys(ids[:-1], ids[1:]), return_index=True, return_counts=True)
    return np.concatenate((single, pairs)), np.concatenate((m, n)), np.concatenate((before, m[at[1:]][place]))


def cross_entropy_difference(rows: DataFrame, models: Models) -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, difference) for every row of ``split``."""
    small_batches(rows.sparkSession)
    hot = {c: models.hot[c].to_numpy() for c in models.hot.columns}
    shared = rows.sparkSession.sparkContext.broadcast((hot, models.fields))
    sides = ("target", "background")
    whole = [t + ADDED * models.vocabulary for t in models.totals]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot, fields = shared.value
        for batch in batches:
            out = []
            for ids, *flags in zip(batch["ids"], batch["target"], batch["background"]):
                ids = np.asarray(ids, np.int64)
                if not len(ids):
                    out.append((0.0, 0.0, ids, ids, ids))
                    continue
                keys, m, before = own_keys(ids)
                at = places(hot["key"], keys)
                here, losses = at >= 0, []
                for name, counted_in, total in zip(sides, flags, whole):
                    scale = total - counted_in * len(ids)
                    x, y = (hot[f"{v}_{name}"][at[here]] - counted_in * own[here] for v, own in (("x", m), ("y", before)))
                    losses.append(len(ids) * np.log2(scale / ADDED) + terms(np, hot["pair"][at[here]], m[here], before[here], x, y, scale).sum())
                rest = ~here & in_field(fields[any(flags)], keys)
                out.append((*losses, keys[rest], m[rest], before[rest]))
            yield pd.DataFrame({
                "row": batch["row"], "n_tokens": [len(i) for i in batch["ids"]], "target": batch["target"], "background": batch["background"],
                "sum_target": [float(o[0]) for o in out], "sum_background": [float(o[1]) for o in out],
                "keys": objects([o[2] for o in out]), "m": objects([o[3] for o in out]), "before": objects([o[4] for o in out])})

    scored = written(rows.select("row", "ids", "target", "background").mapInPandas(
        read, "row bigint, n_tokens bigint, target boolean, background boolean, sum_target double, sum_background double, "
              "keys array<bigint>, m array<int>, before array<int>"), "scored")
    # Number of tokens and marks of the text travel as one value.
    about = (F.col("n_tokens") * 4 + F.col("target").cast("int") * 2 + F.col("background").cast("int")).alias("about")
    each = scored.select("row", about, F.explode(F.arrays_zip("keys", "m", "before")).alias("k"))
    each = each.select("row", "about", F.col("k.keys").alias("key"), F.col("k.m").alias("m"), F.col("k.before").alias("before"))
    met = each.join(models.rare.drop("texts").hint("merge"), F.col("key") == F.col("rare_key"))

    def term(name: str, total: float) -> Column:
        counted_in = (F.col("about").bitwiseAND(F.lit(2 if name == "target" else 1)) > 0).cast("int")
        scale = total - counted_in * F.shiftright("about", 2)
        x, y = F.col(f"x_{name}") - counted_in * F.col("m"), F.col(f"y_{name}") - counted_in * F.col("before")
        return F.sum(terms(F, F.col("pair"), F.col("m"), F.col("before"), x, y, scale)).alias(f"more_{name}")

    more = met.groupBy(F.col("row").alias("of")).agg(*[term(n, t) for n, t in zip(sides, whole)])
    # A text without rare keys has no row on the other side.
    out = scored.drop("keys", "m", "before").join(more, F.col("row") == F.col("of"), "left")
    ids = rows.select(F.col("row").alias("id_row"), "doc_id")
    out = out.join(ids, F.col("row") == F.col("id_row"))
    mean = lambda name: F.when(F.col("n_tokens") > 0, F.round(
        (F.col(f"sum_{name}") + F.coalesce(f"more_{name}", F.lit(0.0))) / F.col("n_tokens"), 9)).alias(f"loss_{name}")
    out = out.select("doc_id", "n_tokens", *[mean(n) for n in sides])
    return out.withColumn("difference", F.round(F.col("loss_target") - F.col("loss_background"), 9))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split(marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return cross_entropy_difference(rows, train(rows))
