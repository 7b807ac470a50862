"""N-gram Jaccard join with a token-group matrix.

Documents with equal shingle sets are one class. Two classes link when their
sets have a Jaccard similarity of at least t. The result is exact: the steps
below leave out only pairs that cannot link, or that are already connected.

1. Tokens (shingles) have one global order: by hash, but those frequent in a
   sample come last. Any order is right; this one keeps lists short. If two
   classes link, they share a token among the first n - ceil(t n) + 1 of each:
   its prefix. Tokens held by one row only are dropped with the help of a bit
   field of fixed size and an exact count.
2. Groups of similar classes: classes that agree on a band of min-hashes look at
   one of the largest group there, a seeded choice, and such pairs are verified.
   Links make groups whose members are connected; a further round joins what
   other choices find. This step may miss links; it only makes the next one small.
3. Matrix: the union of the prefix tokens of each group, by bands of similar
   size, one row per (token, group, band), for tokens of several groups.
4. A class looks up its tokens in the matrix and counts those it shares with
   each larger group. Only tokens with enough behind them in both count: if two
   sets overlap in o, all but o - d of the tokens they share have at least o - d
   behind them in both, for any d. With few more than the one that must be left,
   a passage that many sets end with is looked up only by those that consist of
   it, which link with each other, and not by all that hold it. If two sets share s tokens of their prefixes, they overlap
   in at most s plus the longer of their remainders behind the prefixes (of the
   one whose prefix ends first, every shared prefix token is in the other's), and
   in at most s plus what either has behind the last shared token. A group has
   only the first of these, and one plus what the class has behind the first
   shared token: the last may be shared with another member than the one that
   links. Only bands that these bounds, with the sizes of their members, let
   reach what t asks for are opened: the class and the members, one row each
   with their tokens, meet by group and band, in blocks of bounded size. Members
   are bounded one by one there, and what is left is verified on whole texts.

Groups of copies and of near copies, however large, shrink to one row per token
before anything is paired; links are counted once per class, not per pair.

Cases: null texts and texts without words have an empty set and are linked with
nothing. Texts with fewer words than k are one shingle. Repeated rows and equal
texts share a component. A null id never names a component unless all its ids
are null. Further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_before, as_text, objects, small_batches, staged, table
from .graph import components
from .shingles import K, Shingler, overlap, signature

# Similarity as a whole number of hundredths, so that the test is exact.
THRESHOLD = 75
# For the order of tokens only: about so many sampled texts, and the count that makes a token frequent.
SAMPLE, FREQUENT, MAX_FREQUENT = 16_000, 4, 1 << 17
# Step 2: bands, min-hashes in each (two classes that just link agree on some band with 99.8 %), and rounds.
BANDS, HASHES, ROUNDS = 12, 3, 2
# Members and queries of an opened band that meet in one block, and rows of small blocks that are handed over together.
MEMBERS, QUERIES, TOGETHER = 2048, 4096, 512
# Sizes of one band of a group differ by less than this factor.
BAND = 1.1
# One in so many of the tokens that a link needs is looked up beyond the first; any number gives the same links.
SPARE = 32
# Bits of the field that tells which tokens may be held twice; its size is fixed.
FIELD_BITS = 26


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def needed(n: Column, m: Column, threshold: int = THRESHOLD) -> Column:
    """The least overlap of two sets of sizes n and m that link."""
    return F.ceil((n + m) * threshold / (100 + threshold) - 1e-9)


def frequent_tokens(docs: DataFrame, k: int = K) -> np.ndarray:
    """Tokens that occur often in a hash sample of the texts, rarest first. At most MAX_FREQUENT."""
    share = min(1.0, SAMPLE / max(1, docs.count()))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(k)
        for batch in batches:
            yield pd.DataFrame({"tokens": objects([shingle(t) for t in batch["text"]])})

    chosen = docs.filter(F.pmod(F.xxhash64(F.lit("order"), "text"), F.lit(1_000_000)) < int(share * 1_000_000)).select("text")
    counts = chosen.mapInPandas(read, "tokens array<bigint>").select(F.explode("tokens").alias("token")).groupBy("token").count()
    rows = counts.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).toArrow().to_pandas()
    return rows.sort_values(["count", "token"])["token"].to_numpy(np.int64)


_MIXERS = (np.random.default_rng(5).integers(1, 2**62, BANDS * HASHES, dtype=np.int64) * 2 + 1).astype(np.uint64)


def bands(found: np.ndarray) -> np.ndarray:
    """One number for each band of min-hashes of a set; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    tokens = found.view(np.uint64)
    least = np.multiply.outer(_MIXERS, tokens).min(axis=1).reshape(BANDS, HASHES)
    state = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(HASHES):
        state = (state ^ least[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        state ^= state >> np.uint64(29)
    return state.view(np.int64)


def prefixes(docs: DataFrame, frequent: np.ndarray, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """(doc_id, row_key, n, sig, prefix, bands) per row; the prefix in the global order of tokens."""
    order = np.argsort(frequent, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, rank_of = shared.value
        shingle = Shingler(k)

        def prefix(found: np.ndarray) -> np.ndarray:
            size = len(found) + (-threshold * len(found)) // 100 + 1 if len(found) else 0
            rank = np.zeros(len(found), np.int64)
            if len(known):
                at = np.searchsorted(known, found)
                at[at == len(known)] = 0
                rank = np.where(known[at] == found, rank_of[at] + 1, rank)
            # The set is sorted already.
            return found[np.argsort(rank, kind="stable")[:size]]

        for batch in batches:
            sets = [shingle(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "row_key": batch["row_key"], "n": [len(s) for s in sets],
                "sig": [signature(s) for s in sets], "prefix": objects([prefix(s) for s in sets]), "bands": objects([bands(s) for s in sets])})

    rows = as_text(docs.select(row_key().alias("row_key"), "doc_id", "text"), "doc_id")
    return as_before(rows.mapInPandas(read, "doc_id string, row_key bigint, n bigint, sig bigint, prefix array<bigint>, bands array<bigint>"), docs, "doc_id")


def bit_field(tokens: DataFrame, bits: int = FIELD_BITS) -> np.ndarray:
    """A field of 2**bits bits in which those of ``tokens`` are set, by their low bits."""
    slot = F.col("token").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    rows = tokens.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow().to_pandas()
    field = np.zeros(1 << (bits - 6), np.int64)
    field[rows["w"]] = rows["b"]
    return field


def in_field(field: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    slot = tokens & (len(field) * 64 - 1)
    return (field[slot >> 6] >> (slot & 63)) & 1 == 1


def shared_tokens(rows: DataFrame) -> DataFrame:
    """(token, sig, n, rest) of the prefix tokens that more than one row holds, once per class.

    ``rest`` is how many tokens of the set come after it.
    """
    counts = rows.select(F.explode("prefix").alias("token")).groupBy("token").count()
    field = rows.sparkSession.sparkContext.broadcast(bit_field(counts.filter(F.col("count") > 1)))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = [np.flatnonzero(in_field(field.value, np.asarray(p, np.int64))) for p in batch["prefix"]]
            yield pd.DataFrame({
                "sig": batch["sig"], "n": batch["n"],
                "rest": objects([n - 1 - a for n, a in zip(batch["n"], at)]),
                "tokens": objects([np.asarray(p, np.int64)[a] for p, a in zip(batch["prefix"], at)])})

    kept = rows.filter(F.col("n") > 0).select("sig", "n", "prefix").mapInPandas(keep, "sig bigint, n bigint, rest array<bigint>, tokens array<bigint>")
    each = kept.select("sig", "n", F.explode(F.arrays_zip("tokens", "rest")).alias("x"))
    return each.select(F.col("x.tokens").alias("token"), "sig", "n", F.col("x.rest").alias("rest")).distinct()


def enough(least: Column) -> Column:
    """What is behind a token in both sets, if it is looked up for an overlap of ``least``."""
    return least - 1 - F.floor(least / SPARE)


def prefix_size(n: Column, threshold: int = THRESHOLD) -> Column:
    return n - F.ceil(n * threshold / 100 - 1e-9) + 1


def verified(pairs: DataFrame, texts: DataFrame, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """The pairs (a, b) of classes whose whole texts link; ``texts`` is (sig, text)."""
    rows = pairs.join(texts.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.join(texts.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, last, other = Shingler(k), None, None
        for batch in batches:
            good = []
            for b, text_a, text_b in zip(batch["b"], batch["text_a"], batch["text_b"]):
                if b != last:
                    last, other = b, shingle(text_b)
                mine = shingle(text_a)
                both = overlap(mine, other)
                good.append(100 * both >= threshold * (len(mine) + len(other) - both))
            yield batch.loc[good, ["a", "b"]]

    return rows.select("a", "b", "text_a", "text_b").mapInPandas(check, "a bigint, b bigint")


def class_texts(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(sig, text) for the classes in ``pairs``, from one row of each.

    The bit field spares texts that are not asked for the shuffle.
    """
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    one = staged(rows.groupBy("sig").agg(F.min("row_key").alias("row_key")).join(wanted, "sig"), "wanted")
    field = docs.sparkSession.sparkContext.broadcast(bit_field(one.select(F.col("row_key").alias("token"))))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[in_field(field.value, batch["k"].to_numpy())]

    keyed = docs.select(row_key().alias("k"), "text").mapInPandas(keep, "k bigint, text string")
    return keyed.join(one, F.col("k") == F.col("row_key")).select("sig", "text").dropDuplicates(["sig"])


def in_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, sig, n, rest, group) on the tokens that several groups hold."""
    rows = rows.select("token", "sig", "n", "rest").join(groups, F.col("sig") == F.col("node"), "left").select(
        "token", "sig", "n", "rest", F.coalesce("component", "sig").alias("group"))
    several = rows.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter(F.col("low") < F.col("high"))
    several = staged(several.select(F.col("token").alias("t")), "several")
    return staged(rows.join(several, F.col("token") == F.col("t"), "left_semi"), "grouped")


def band_rows(rows: DataFrame) -> DataFrame:
    """(key, sig, n) of the min-hash bands on which several classes agree."""
    each = rows.select("sig", "n", F.explode("bands").alias("key")).distinct()
    several = each.groupBy("key").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).filter(F.col("low") < F.col("high"))
    return each.join(several.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi")


def star_pairs(rows: DataFrame, groups: DataFrame, seed: int, threshold: int = THRESHOLD) -> DataFrame:
    """Classes with a chosen one of the largest group on a band, where their sizes let them link."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    of = groups.join(sizes, "component").select("node", "component", "members")
    rows = rows.join(of, F.col("sig") == F.col("node"), "left").select(
        "key", "sig", "n", F.coalesce("component", "sig").alias("group"), F.coalesce("members", F.lit(1)).alias("members"))
    first = rows.groupBy("key").agg(F.max(F.struct(
        "members", F.xxhash64(F.lit(seed), "group", "key").alias("order"), F.xxhash64(F.lit(seed), "sig").alias("place"), "sig", "n", "group")).alias("c"))
    rows = rows.join(first.select(F.col("key").alias("k"), "c"), F.col("key") == F.col("k")).filter(F.col("group") != F.col("c.group"))
    fits = 100 * F.least(F.col("n"), F.col("c.n")) >= threshold * F.greatest(F.col("n"), F.col("c.n"))
    return rows.filter(fits).select(F.col("sig").alias("a"), F.col("c.sig").alias("b")).distinct()


def size_bounds(threshold: int) -> tuple[Column, Column, Column]:
    """The least and greatest size between ``low`` and ``high`` that can link with n, and the overlap that the least asks for."""
    least = F.greatest(F.col("low"), F.ceil(F.col("n") * threshold / 100 - 1e-9))
    most = F.least(F.col("high"), F.floor(F.col("n") * 100 / threshold + 1e-9))
    return least, most, needed(F.col("n"), least, threshold)


def lookups(rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """A row for each token that a class shares with a band of a larger group, with enough behind it in both."""
    # The smaller of two sets that link has as much behind a token as a link with its own size asks for.
    rows = rows.withColumn("early", F.col("rest") >= enough(needed(F.col("n"), F.col("n"), threshold)))
    met = F.when(F.col("early"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    matrix = rows.groupBy("token", "group", "band").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("most"), F.max("early").alias("early")).select(
        F.col("token").alias("t"), "group", "band", "low", "high", "most", F.explode(met).alias("met"))
    least, most, asked = size_bounds(threshold)
    fits = (least <= most) & (F.col("rest") >= enough(asked)) & (F.col("most") >= enough(asked))
    query = rows.select("token", F.col("sig").alias("a"), "n", "rest", F.col("group").alias("own"), "early")
    return query.join(staged(matrix, "matrix"), (F.col("token") == F.col("t")) & (F.col("early") == F.col("met")) & (F.col("own") < F.col("group")) & fits)


def matrix_pairs(rows: DataFrame, groups: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Candidate pairs of classes in different groups, through the token-group matrix."""
    members = groups.groupBy("component").agg(F.count("*").alias("members"))
    rows = rows.join(members, F.col("group") == F.col("component"), "left")
    # Each pair of groups is looked up from the smaller one.
    rows = rows.select("token", "sig", "n", "rest", F.struct(F.coalesce("members", F.lit(1)).alias("members"), "group").alias("group"),
                       F.floor(F.log("n") / float(np.log(BAND))).alias("band"))
    rows = staged(rows, "banded")
    looked = lookups(rows, threshold).groupBy("a", "n", "group", "band").agg(
        F.count("*").alias("shared"), F.max("rest").alias("behind"), F.min("low").alias("low"), F.max("high").alias("high"))
    least, most, asked = size_bounds(threshold)
    rest = F.greatest(F.col("n") - prefix_size(F.col("n"), threshold), most - prefix_size(most, threshold), enough(asked))
    # Of the tokens shared with any member, only the first bounds the overlap with each of them.
    reach = F.least(F.col("shared") + rest, F.col("behind") + 1)
    opened = staged(looked.filter((least <= most) & (reach >= asked)).select(
        F.col("a").alias("oa"), F.col("group").alias("og"), F.col("band").alias("ob")), "opened")
    return opened_pairs(rows.withColumn("group", F.col("group.group")), opened.withColumn("og", F.col("og.group")), threshold)


def opened_pairs(rows: DataFrame, opened: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of a class and a member of a band opened for it that can link.

    Each is one row with its tokens. The members of a band, and the classes it
    is opened for, are dealt into blocks that fit a task, and every block of one
    meets every block of the other. Most blocks are small: about ``TOGETHER`` rows
    of them go to Python at once.
    """
    tokens = F.collect_list(F.struct("token", "rest"))
    inside = opened.groupBy(F.col("og").alias("g"), F.col("ob").alias("at")).agg(F.count("*").alias("queries"))
    same = (F.col("group") == F.col("g")) & (F.col("band") == F.col("at"))
    members = rows.join(inside, same, "left_semi").groupBy("sig", "n", "group", "band").agg(tokens.alias("t"))
    members = staged(members.select("sig", "n", "group", "band", F.col("t.token").alias("tokens"), F.col("t.rest").alias("rests")), "members")
    total = members.count() + opened.count()
    held = members.groupBy("group", "band").agg(F.count("*").alias("members"))
    blocks = lambda n, each: F.ceil(F.col(n) / each).cast("int")
    inside = inside.join(held, same).select("g", "at", blocks("members", MEMBERS).alias("mb"), blocks("queries", QUERIES).alias("qb"))
    inside = staged(inside, "blocks")
    asked = rows.join(opened.select(F.col("oa").alias("sig")).distinct(), "sig", "left_semi").groupBy("sig", "n").agg(tokens.alias("t"))
    asked = asked.join(opened, F.col("sig") == F.col("oa")).join(inside, (F.col("og") == F.col("g")) & (F.col("ob") == F.col("at")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("sig"), F.col(n)).cast("int")
    asked = asked.select("sig", "n", F.col("t.token").alias("tokens"), F.col("t.rest").alias("rests"),
                         F.col("og").alias("g"), F.col("ob").alias("at"), mine("qb").alias("q"), every("mb").alias("m"))
    members = members.join(inside, same).select("sig", "n", "tokens", "rests", "g", "at", mine("mb").alias("m"), every("qb").alias("q"))
    block = F.xxhash64("g", "at", "m", "q")
    dealt = lambda df: df.select("sig", "n", "tokens", "rests", block.alias("block"), F.pmod(block, F.lit(total // TOGETHER + 1)).alias("bundle")).groupBy("bundle")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found, blocks = [], right.groupby("block").indices
        for key, asking in left.groupby("block").indices.items():
            block = right.iloc[blocks.get(key, [])]
            table, sigs = MemberTable(block), block["sig"].to_numpy(np.int64)
            queries = left.iloc[asking]
            for a, n, t, r in zip(queries["sig"], queries["n"], queries["tokens"], queries["rests"]):
                b = sigs[bounded(int(n), np.asarray(t, np.int64), np.asarray(r, np.int64), table, threshold)]
                found.append(np.stack((np.full(len(b), a, np.int64), b)))
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        return pd.DataFrame({"a": a, "b": b})

    return dealt(asked).cogroup(dealt(members)).applyInPandas(meet, "a bigint, b bigint")


class MemberTable:
    """The tokens of a block of members, sorted, with whose they are; and member by member, with what comes after."""

    def __init__(self, members: pd.DataFrame) -> None:
        counts = np.array([len(t) for t in members["tokens"]], np.int64)
        self.tokens = np.concatenate([np.zeros(0, np.int64), *members["tokens"]]).astype(np.int64)
        self.rest = np.concatenate([np.zeros(0, np.int64), *members["rests"]]).astype(np.int64)
        self.sizes, self.counts, self.begins = members["n"].to_numpy(np.int64), counts, np.cumsum(counts) - counts
        order = np.argsort(self.tokens, kind="stable")
        self.sorted, self.owner = self.tokens[order], np.repeat(np.arange(len(counts)), counts)[order]


def stretches(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its count."""
    return np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def bounded(n: int, tokens: np.ndarray, rests: np.ndarray, members: MemberTable, threshold: int) -> np.ndarray:
    """Which members can link with a set of n tokens, by what their prefixes share.

    They overlap in at most that and the longer remainder behind the prefixes, or that
    and what either has behind the last shared token. Members that share too few of the
    tokens with enough behind them, as in the lookup, are not compared any further."""
    m = members.sizes
    least = -(-(n + m) * threshold // (100 + threshold))
    after = np.maximum(-(-n * threshold // 100), -(-m * threshold // 100)) - 1
    fits = 100 * np.minimum(n, m) >= threshold * np.maximum(n, m)
    if not fits.any():
        return np.zeros(0, np.int64)
    behind_enough = least - 1 - least // SPARE
    first = tokens[rests >= behind_enough[fits].min()]
    low = np.searchsorted(members.sorted, first)
    owner = members.owner[stretches(low, np.searchsorted(members.sorted, first, "right") - low)]
    shared = np.bincount(owner, minlength=len(m))
    near = np.flatnonzero(fits & (shared > 0) & (shared + np.maximum(after, behind_enough) >= least))
    at = stretches(members.begins[near], members.counts[near])
    owner = np.repeat(np.arange(len(near)), members.counts[near])
    order = np.argsort(tokens)
    place = np.minimum(np.searchsorted(tokens[order], members.tokens[at]), len(tokens) - 1)
    met = tokens[order][place] == members.tokens[at]
    at, owner, place = at[met], owner[met], place[met]
    shared = np.bincount(owner, minlength=len(near))
    behind = np.full(len(near), np.iinfo(np.int64).max)
    np.minimum.at(behind, owner, np.minimum(members.rest[at], rests[order][place]))
    return near[shared + np.minimum(after[near], behind) >= least[near]]


def near_groups(docs: DataFrame, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id) for every row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = staged(prefixes(docs, frequent_tokens(docs, k), threshold, k), "prefixes")
    alike = staged(band_rows(rows), "alike")
    links = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    groups = docs.sparkSession.createDataFrame([], "node bigint, component bigint")
    for seed in range(ROUNDS):
        pairs = staged(star_pairs(alike, groups, seed, threshold), "stars")
        if pairs.isEmpty():
            break
        more = verified(pairs, staged(class_texts(docs, rows, pairs), "texts"), threshold, k)
        links = staged(links.union(more), "links")
        groups = components(links)
    pairs = staged(matrix_pairs(in_groups(shared_tokens(rows), groups), groups, threshold), "pairs")
    more = verified(pairs, staged(class_texts(docs, rows, pairs), "texts"), threshold, k)
    groups = components(links.union(staged(more, "links")))
    rows = rows.select("doc_id", "row_key", "n", "sig").join(groups, F.col("sig") == F.col("node"), "left")
    rows = staged(rows.select("doc_id", "row_key", "n", F.coalesce("component", "sig").alias("group")), "grouped")
    least = staged(rows.groupBy("group").agg(F.min("doc_id").alias("least")).select(F.col("group").alias("g"), "least"), "least")
    out = rows.join(least, F.col("group") == F.col("g"), "left")
    # Without words nothing is linked, not even equal texts.
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "row_key", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("row_key")


def without_near_copies(docs: DataFrame, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of equal ids the smallest row key."""
    found = staged(near_groups(docs, threshold, k), "near")
    first = F.min(F.struct("doc_id", "row_key"))
    linked = found.filter(F.col("n_shingles") > 0)
    keep = linked.groupBy("component_id").agg(first.alias("x")).select(F.col("x.row_key").alias("__keep"))
    names = docs.columns
    empty = F.coalesce(~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(True))
    keyed = docs.select(F.struct("*").alias("__row"), row_key().alias("__key"), empty.alias("__empty"))
    kept = keyed.filter(~F.col("__empty")).join(keep, F.col("__key") == F.col("__keep"), "left_semi").dropDuplicates(["__key"])
    out = kept.select("__row").union(keyed.filter("__empty").select("__row"))
    return out.select(*[F.col("__row").getField(c).alias(c) for c in names])


SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, CASE WHEN len(w) < {K} THEN w ELSE w[p : p + {K - 1}] END AS s
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - {K - 2}))) AS p FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
  SELECT x.r AS a, y.r AS b, count(*) AS inter FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
  WHERE 100 * inter >= {THRESHOLD} * (p.n + q.n - inter)
), reach AS (
  SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.b GROUP BY a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (r) JOIN least ON least.a = docs.r
"""
