"""The manifest against trees built one node at a time."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docsheaf.llm import op11_merkle as op11

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, g string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def climb(nodes, arity):
    """The top of a list of digests, and each one's siblings level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i:i + arity] for i in range(0, len(level), arity)]
        for path, i in zip(paths, at):
            run = runs[i // arity]
            path.append(("".join(run[:i % arity]), "".join(run[i % arity + 1:])))
        level, at = [sha("".join(r)) for r in runs], [i // arity for i in at]
    return level[0], paths


def plain(rows, arity):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops, found = [], {}
    for lang in order:
        group = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = climb([leaf(r) for r in group], arity)
        tops.append(top)
        found[lang] = top, group, paths
    root, above = climb(tops, arity)
    return root, sorted(((r[0], leaf(r), found[x][0], root, p + above[k]) for k, x in enumerate(order) for r, p in zip(*found[x][1:])), key=repr)


def rows_of(n, langs=("en", None, "de", "", "zß", "one")):
    rng = random.Random(n)
    rows = [(i, None if i % 9 == 0 else f"s{i % 3}", langs[0] if i % 3 else rng.choice(langs[:-1]), i if i % 4 else None, f"täxt {i}" if i % 5 else None, "x", "y") for i in range(n)]
    rows += [(n, "s", langs[-1], 1, "alone", "x", "y"), (None, None, None, None, None, None, None), (None, "s", langs[0], 2, "no id", None, None), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,arity,levels", [(300, 2, 10), (300, 2, 3), (150, 3, 2), (40, 5, 1), (1, 2, 2)])
def test_paths_subroots_and_root(spark, n, arity, levels):
    rows = rows_of(n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = op11.manifest(docs, arity=arity, levels=levels)
    found = found.withColumns({"folded": op11.folded(F.col("leaf"), F.col("path")), "proof": op11.proof_digest(F.col("path"))}).collect()
    got = sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in found), key=repr)
    root, want = plain(rows, arity)
    assert got == want
    assert {r["folded"] for r in found} == {root}
    assert all(r["proof"] == sha("".join(a + b for a, b in r["path"])) for r in found)


def test_one_leaf_is_its_own_root(spark):
    docs = spark.createDataFrame([(1, "s", "en", 3, "abc", "", "")], SCHEMA)
    row = op11.manifest(docs).first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf((1, "s", "en", 3, "abc")) and row["path"] == []


def test_blocks_share_nothing_but_tops(spark):
    """A hot group of 2,000 leaves lies in blocks of 8, over many tasks."""
    nodes = spark.range(2000).select(F.lit("+en").alias("g"), F.col("id").alias("pos"), F.lit(2000).cast("long").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    rows = op11.climbed(nodes.repartition(4), 2, 3)
    assert rows.groupBy("block").count().agg(F.max("count"), F.count("*")).first()[:] == (8, 250)
    top, paths = climb([sha(str(i)) for i in range(2000)], 2)
    rows = op11.trees(nodes, 2, 3).collect()
    assert {r["top"] for r in rows} == {top}
    assert [[tuple(s) for s in r["path"]] for r in sorted(rows, key=lambda r: r["pos"])] == paths


def test_other_fields_groups_and_orders(spark):
    docs = spark.createDataFrame([(2, "b", 10), (1, "a", 10), (3, "c", None)], "k int, v string, part int")
    rows = {r["k"]: r for r in op11.manifest(docs, {"again": F.col("v")}, ("v",), "part", "k").collect()}
    a, b, c = (sha(f"1:{v}") for v in "abc")
    assert rows[1]["subroot"] == rows[2]["subroot"] == sha(a + b) and rows[3]["subroot"] == c
    assert rows[1]["root"] == sha(c + sha(a + b)) and [r["again"] for r in rows.values()] != []
    assert [tuple(s) for s in rows[2]["path"]] == [(a, ""), (c, "")]
