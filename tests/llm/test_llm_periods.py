"""Runs against a search of every period at every place."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docsheaf.llm import op12_periods as op12
from small_corpus import prose


def plain(words, min_length=op12.MIN_LENGTH, times=op12.TIMES):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def found(words, **how):
    return op12.runs(op12.numbered(words), **how)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_two_words(words):
    assert found(words) == plain(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(1, 12), st.integers(0, 8)), max_size=7))
def test_powers_end_to_end(parts):
    words = [w for unit, times, cut in parts for w in (unit * times)[:len(unit) * times - min(cut, len(unit) - 1)]]
    assert found(words) == plain(words)


@pytest.mark.parametrize("seed", range(6))
def test_long_periods(seed):
    rng = random.Random(seed)
    words = prose(rng, 300).split()
    for _ in range(4):
        unit = prose(rng, rng.choice([1, 2, 3, 17, 64, 129, 300])).split()
        words += (unit * 9)[:len(unit) * 4 + rng.randint(0, len(unit) * 5)]
        words += prose(rng, rng.randint(0, 40)).split()
    assert found(words) == plain(words)
    assert found(words, times=5, min_length=20) == plain(words, 20, 5)


def test_one_word_and_nested_periods():
    assert found(["a"] * 20_000) == [(0, 20_000, 1)]
    unit = ["a"] * 8 + ["b"]
    words = unit * 1000
    assert found(words)[0] == (0, 8, 1) and (0, 9000, 9) in found(words) and len(found(words)) == 1001
    assert found(unit * 12) == plain(unit * 12)
    assert found([]) == found(["a"] * 5) == [] and found(["a"] * 6) == [(0, 6, 1)]


def test_more_words_than_values():
    """Numbers are folded below VALUES: blocks that only look alike are no runs."""
    words = [f"w{k % op12.VALUES + op12.VALUES * (k // op12.VALUES)}" for k in range(op12.VALUES * 6)]
    assert found(words) == []
    words = [f"w{k}" for k in range(700)] * 5
    assert found(words) == [(0, 3500, 700)]


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_sums_are_exact(size):
    rng = np.random.default_rng(size)
    top = min(op12.VALUES, int((op12.PRIME // size) ** 0.5))
    blocks, windows = rng.integers(0, top, (5, size)), rng.integers(0, top, (5, 2 * size - 1))
    blocks[0], windows[0], windows[1] = top - 1, top - 1, 0
    want = [[int(((b - w[k:k + size]) ** 2).sum()) for k in range(size)] for b, w in zip(blocks, windows)]
    assert op12.mismatches(blocks.astype(np.uint64), windows.astype(np.uint64)).tolist() == want
    rows = rng.integers(0, op12.PRIME, (3, 2 * size)).astype(np.uint64)
    assert (op12.inverse(op12.transform(rows)) == rows).all()


def test_collapsed_texts(spark):
    rows = [(1, "x  the cat the cat the cat the cat sat", "k"), (2, " no  runs\there ", "k"), (None, None, None), (3, "", None), (4, "a " * 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {r["doc_id"]: r for r in op12.collapsed(docs).collect()}
    assert [got[i]["text"] for i in (1, 2, None, 3, 4)] == ["x the cat sat", " no  runs\there ", None, "", "a"]
    assert got[1]["runs"] == "k" and op12.collapsed(docs).columns == docs.columns
    found = {r["doc_id"]: r for r in op12.periodic(docs).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(1, 8, 2)] and found[None]["runs"] == [] and found[None]["collapsed"] == ""
