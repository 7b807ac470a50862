"""Rows that an operator must not leave out."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsheaf.llm import op2_decontaminate as op2
from docsheaf.llm import op3_substring as op3
from docsheaf.llm import op5_jaccard as op5
from docsheaf.llm.shingles import Shingler, signature
from small_corpus import WORDS, prose


def test_groups_open_for_members_of_other_prefixes(spark):
    """A class links with one member of a group while it shares later prefix tokens with another."""
    shingle = Shingler(1)
    names = sorted((f"w{i}" for i in range(114)), key=lambda w: int(shingle(w)[0]))
    x, t, y = names[:24], names[24:100], names[100:]
    texts = {"a": t, "b": x + t, "c": x[12:] + t[:2] + t[4:] + y}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id string, text string")
    sig = {k: signature(shingle(" ".join(v))) for k, v in texts.items()}
    rows = op5.prefixes(docs, np.zeros(0, np.int64), k=1)
    groups = spark.createDataFrame([(sig["b"], sig["b"]), (sig["c"], sig["b"])], "node long, component long")
    pairs = op5.matrix_pairs(op5.in_groups(op5.shared_tokens(rows), groups), groups)
    assert {sig["a"], sig["b"]} in [{r["a"], r["b"]} for r in pairs.collect()]
    found = op5.near_groups(docs, k=1).select("doc_id", "component_id").collect()
    assert {r["component_id"] for r in found} == {"a"}


def test_a_common_end_is_not_looked_up(spark):
    """Sets that share four fifths do not link; what they share ends all of them and meets no other set."""
    shingle = Shingler(1)
    passage = [f"p{i}" for i in range(80)]
    texts = [(k, " ".join([f"own{k}x{i}" for i in range(20)] + passage)) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    groups = spark.createDataFrame([], "node long, component long")
    rows = op5.in_groups(op5.shared_tokens(op5.prefixes(docs, shingle(" ".join(passage)), k=1)), groups)
    assert rows.groupBy("token").count().filter("count = 40").count() == 6
    assert op5.lookups(rows.withColumn("band", F.lit(0))).count() == 0


def test_the_matrix_alone_finds_every_link(spark, monkeypatch):
    """Sets of all sizes that end alike, without the first step: the components of comparing all pairs, in small blocks."""
    monkeypatch.setattr(op5, "ROUNDS", 0)
    monkeypatch.setattr(op5, "TOGETHER", 7)
    rng = random.Random(13)
    ends = [[f"e{j}x{i}" for i in range(90)] for j in range(3)]
    sets = []
    for k in range(150):
        end = ends[k % 3]
        sets.append({*rng.sample(end, rng.randint(55, 90)), *(f"o{rng.randrange(12)}x{i}" for i in range(rng.randint(0, 25)))})
    up = list(range(len(sets)))
    for b in range(len(sets)):
        for a in range(b):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and up[a] != up[b]:
                low, high = sorted((up[a], up[b]))
                up = [low if x == high else x for x in up]
    docs = spark.createDataFrame([(k, " ".join(sorted(v))) for k, v in enumerate(sets)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in op5.near_groups(docs, k=1).collect()}
    assert 5 < len(set(up)) < 140 and got == dict(enumerate(up))


def test_edited_items_are_found_as_by_full_alignment(spark):
    """Every second to sixth word replaced, put in or left out: the same pairs as aligning everything."""
    rng = random.Random(11)
    items = [(k, " ".join(rng.sample(WORDS, n))) for k, n in enumerate((15, 20, 24, 37, 48, 59))]
    docs = []
    for _, text in items:
        words = text.split()
        for every in (2, 3, 4, 5, 6):
            edits = [[f"new{j}" if j % every == every - 1 else w for j, w in enumerate(words)],
                     [w for j, w in enumerate(words) if j % every],
                     [x for j, w in enumerate(words) for x in ([w] if j % every else [f"new{j}", w])]]
            docs += [" ".join([prose(rng, 40), *e, prose(rng, 40)]) for e in edits]
    rows = list(enumerate(docs))
    hashes = op2.WordHashes()
    want = {(i, k): op2.align(hashes(t), hashes(x))[0] / (op2.MATCH * len(x.split())) for i, t in rows for k, x in items}
    want = {p: s for p, s in want.items() if s >= op2.MIN_SCORE}
    frame = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in op2.leaks(*frame).collect()}
    assert len(want) > 60 and got == pytest.approx(want)


def test_scattered_words_are_not_aligned():
    """The bound is never below the score, and low where an item's words stand far apart."""
    rng = random.Random(14)
    numbers = lambda values: np.array(values, np.uint64)
    for _ in range(200):
        item, text = ([rng.randrange(25) for _ in range(n)] for n in (rng.randint(4, 30), rng.randint(1, 60)))
        if rng.random() < 0.5:
            text[3:3] = [w for w in item if rng.random() < 0.8]
        score = op2.align(numbers(text), numbers(item))[0] / (op2.MATCH * len(item))
        assert op2.ItemWords(numbers(item)).most_score(numbers(text)) >= score
    apart = [x for w in range(20) for x in (w, 101, 102, 103)]
    assert op2.ItemWords(numbers(range(20))).most_score(numbers(apart)) < op2.MIN_SCORE


def test_repeated_spans_meet_by_text(spark):
    """The join with the first of each kind has rows for texts, not for each of their spans."""
    rng = random.Random(15)
    passage = prose(rng, 400).rpartition(".")[0] + "."
    docs = spark.createDataFrame([(k, f"{prose(rng, 20)}.\n{passage}") for k in range(12)], "doc_id long, text string")
    found = op3.repeated_ranges(docs)
    rows = found.collect()
    joins = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("row_key" in line for line in joins)
    assert len(rows) == 11 and len({len(r["ranges"]) for r in rows}) == 1


def test_passages_in_mid_sentence_are_removed(spark):
    """Passages of 50 to 70 words whose first and last sentence are merged with their neighbours."""
    rng = random.Random(12)
    rows, passages = [], []
    for k in range(20):
        passage = prose(rng, rng.randint(50, 70)).rstrip(".")
        passages.append(passage)
        rows += [(2 * k + j, f"{prose(rng, 20).rstrip('.')} {passage[0].lower() + passage[1:]} {prose(rng, 20).lower()}") for j in range(2)]
    got = {r["doc_id"]: r for r in op3.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, passage in enumerate(passages):
        inner = [passage[b:e] for b, e in op3.sentences(passage)][1:-1]
        assert got[2 * k]["n_removed"] == 0
        assert not any(s in got[2 * k + 1]["text"] for s in inner), k


def test_short_sentences_alone_stay():
    text = " ".join(["word"] * 17) + "."
    assert op3.spans(text) == [] and len(op3.spans(text + " " + text)) == 1 and len(op3.spans(" ".join(["word"] * 20) + ".")) == 1
