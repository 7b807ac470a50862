"""Exact copies: every route gives what a dictionary gives."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from docsheaf.llm import op13_exact as op13
from small_corpus import corpus

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(SPACES.sub(" ", text or "").encode()).hexdigest()


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[digest(text)].append(i)
    out = []
    for d, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, d) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def heavy_rows():
    """One text in a third of all rows, thousands of small groups, spaces of all kinds, repeats."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["one  common\ttext", "one common text", "one common\n text"])) for i in range(3000, 5000)]
    rows += [(i, f"text {rng.randrange(2500)}") for i in range(5000, 9000)]
    rows += [(7, " lead"), (8, "\tlead"), (9, "lead"), (None, "no id"), (None, "no id"), (None, "lead"), (10, None), (11, ""), (12, " "), (8, "\tlead")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tracked,most", [(op13.TRACKED, op13.MOST), (16, 4), (1, 1)])
def test_copies_agree_with_a_dictionary(spark, tracked, most):
    rows = heavy_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in op13.copies(docs, tracked, most).collect()]
    assert sorted(got, key=repr) == plain(rows)
    left = op13.without_copies(docs, tracked, most).collect()
    assert sorted((digest(r["text"]), r["doc_id"]) for r in left if r["doc_id"] is not None) == sorted((d, i) for i, _, _, k, d in plain(rows) if k and i is not None)
    assert len(left) == len({digest(t) for _, t in rows})


def test_frequent_digests_are_split_off(spark):
    rows = heavy_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    keyed = docs.select(op13.text_digest(docs["text"]).alias("digest"), op13.rank_key(docs["doc_id"], op13.F.lit(0)).alias("place"))
    found = {r["heavy"]: r["n"] for r in op13.winners(keyed, 64, 8).collect()}
    assert found[digest("one common text")] == 2000 and len(found) <= 8


def test_winners_are_verified_not_estimated(spark):
    """With more digests than counters, estimates are off; what is broadcast is exact."""
    rows = [(i, f"t{i % 400}") for i in range(2000)] + [(i, "hot") for i in range(2000, 2600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keyed = docs.select(op13.text_digest(docs["text"]).alias("digest"), op13.rank_key(docs["doc_id"], op13.F.lit(0)).alias("place"))
    for r in op13.winners(keyed, 32, 8).collect():
        ids = [i for i, t in rows if digest(t) == r["heavy"]]
        assert (r["n"], r["best"]["id"]) == (len(ids), min(ids))


def test_all_columns_stay(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    left = op13.without_copies(docs)
    assert left.columns == docs.columns and left.count() == len({digest(t) for _, t, _, _ in corpus()})
    assert op13.without_copies(docs.limit(0)).count() == 0
