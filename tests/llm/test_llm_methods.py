"""The methods against plain versions of themselves, exact planted cases and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsheaf.llm import op2_decontaminate as op2
from docsheaf.llm import op3_substring as op3
from docsheaf.llm import op4_classifier as op4
from docsheaf.llm import op6_language as op6
from docsheaf.llm import op8_html as op8
from docsheaf.llm import op9_licenses as op9
from docsheaf.llm import op10_lm as op10
from docsheaf.llm.graph import components
from docsheaf.llm.markup import Page, main_text
from docsheaf.llm.op5_jaccard import without_near_copies
from docsheaf.llm.tokens import TokenHashes, tokens
from small_corpus import ITEM, corpus, prose

DOCS = "doc_id long, text string, lang string, source string"


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], DOCS)


# Decontamination

def plain_score(text, item):
    """Smith-Waterman over the whole text, cell by cell."""
    a, b = (op2._WORD.findall(t.lower()) for t in (text, item))
    above, best = [0] * (len(a) + 1), 0
    for w in b:
        row = [0]
        for j, v in enumerate(a):
            row.append(max(0, above[j] + (op2.MATCH if v == w else op2.MISMATCH), above[j + 1] + op2.GAP, row[j] + op2.GAP))
        best, above = max(best, *row), row
    return best / (op2.MATCH * len(b))


def test_leaks_are_those_of_a_full_alignment(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in op2.leaks(docs, items, 0.0).collect()}
    want = {(i, 1): plain_score(t, ITEM) for i, t, _, _ in corpus() if t}
    assert {k for k, v in got.items() if v >= op2.MIN_SCORE} == {k for k, v in want.items() if v >= op2.MIN_SCORE} == {(65, 1), (66, 1)}
    assert all(v == pytest.approx(want[k]) for k, v in got.items()) and 0.5 < got[66, 1] < got[65, 1] == 1


def test_gaps_and_part_copies():
    hashes, words = op2.WordHashes(), ITEM.split()
    item = hashes(ITEM)
    for text in (" ".join(words[:9] + words[11:]), " ".join(words[:9] + ["really", "truly"] + words[9:]), " ".join(words[5:])):
        assert op2.align(hashes("a b " + text + " c d"), item)[0] / (2 * len(item)) == pytest.approx(plain_score(text, ITEM))


# Substring dedup

def plain_dedup(rows):
    """Texts without the sentences of spans met before, in order of id and place."""
    seen, out = {}, {}
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    found = [(no, i, t, a, b, h) for no, i, t in order for h, a, b in op3.spans(t)]
    for no, i, t, a, b, h in sorted(found, key=lambda x: (x[0], x[1], x[3] << 32 | x[4])):
        seen.setdefault(h, (no, i, t, a, b))
    for no, i, t in order:
        gone = {k for h, a, b in op3.spans(t) if seen[h] != (no, i, t, a, b) for k in range(a, b + 1)}
        out[None if no else i, t] = op3.without(t, gone) if gone else t
    return out


def test_repeated_spans_go_where_they_come_later(spark):
    rows = [r for r in corpus() if r[0] is not None]
    want = plain_dedup(rows)
    got = op3.without_repeats(frame(spark, rows)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_removed").collect()
    texts = {r[0]: r[1] for r in rows}
    assert {(r["doc_id"], r["text"]) for r in got} == {(i, want[i, texts[i] or ""]) for i in texts}
    passage = texts[0].split("\n")[1]
    assert sum(passage in r["text"] for r in got) == 1, "the first occurrence stays"
    assert {r["doc_id"] for r in got if r["n_removed"]} >= {4, 8, 12, 60}


def test_sentences_and_spans():
    text = "One two. Three four five!\n\nSix seven? Eight"
    assert [text[b:e] for b, e in op3.sentences(text)] == ["One two.", "Three four five!", "Six seven?", "Eight"]
    assert op3.without(text, {1, 2}) == "One two. Eight" and op3.without(text, {0, 3}) == "Three four five!\n\nSix seven?"
    assert op3.without(text, {0, 1, 2, 3}) == ""
    assert [(a, b) for _, a, b in op3.spans(text, 4)] == [(0, 1), (1, 2), (1, 3)]
    assert op3.spans("one two three", 4) == [] and op3.sentences(" \n ") == []


def test_every_sentence_of_a_passage_is_covered():
    """Spans inside a passage of at least min_words cover all of it, wherever it stands."""
    rng = random.Random(3)
    for _ in range(50):
        passage = prose(rng, rng.randint(60, 120)).rpartition(".")[0] + "."
        if len(passage.split()) < op3.MIN_WORDS:
            continue
        texts = [prose(rng, 30) + ".\n" + passage + "\n" + prose(rng, 30) for _ in range(2)]
        one, two = ({h: (a, b) for h, a, b in op3.spans(t)} for t in texts)
        covered = {k for h in one.keys() & two.keys() for k in range(two[h][0], two[h][1] + 1)}
        inside = {i for i, (b, e) in enumerate(op3.sentences(texts[1])) if texts[1].index(passage) <= b < texts[1].index(passage) + len(passage)}
        assert inside <= covered


# Quality classifier

def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(1).normal(size=30_000)] + [0.5] * 100
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 777, 10_000, 30_100):
        assert op4.kth_largest(df, "x", k) == ordered[k - 1]
    assert op4.kth_largest(df, "x", 30_101) is None and op4.kth_largest(df, "x", 0) is None
    assert op4.kth_largest(spark.createDataFrame([(2.0,)] * 20_000, "x double"), "x", 15_000) == 2.0


def plain_importance(rows, good):
    hashes, raw, target = TokenHashes(), Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(op4.buckets_of(t, hashes).tolist())
        if i in good:
            target.update(op4.buckets_of(t, hashes).tolist())
    n, m = sum(raw.values()) + op4.BUCKETS, sum(target.values())
    p = lambda b: (raw[b] + 1) / n
    ratio = lambda b: math.log((target[b] / m + op4.PRIOR * p(b)) / (1 + op4.PRIOR)) - math.log(p(b))
    return [op4.LENGTH * float(np.mean([ratio(b) for b in found])) if len(found := op4.buckets_of(t, hashes)) else 0.0 for _, t, *_ in rows]


def test_importance_and_draw(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows, _, edge = op4.selection(docs, labels)
    got = sorted((repr(r["doc_id"]), round(r["log_ratio"], 6)) for r in rows.collect())
    good = {i for i in range(67)} - {63, 64}
    table = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted((repr(i), round(s, 6)) for (i, _), s in zip(table, plain_importance(table, good)))
    kept = {r["doc_id"] for r in op4.resampled(docs, labels).collect()}
    assert not kept & {63, 64} and set(range(62)) <= kept


def test_without_labels_all_stay(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert op4.resampled(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == docs.count()


# Components

def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, i) for i in range(400, 600)]
    up = {}
    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in nodes} and len(got) == len(nodes)


def test_near_copies_leave_one(spark):
    rows = corpus()
    got = Counter(r["doc_id"] for r in without_near_copies(frame(spark, rows)).collect())
    assert got[1] == 1 and not {60, 61, 62} & set(got) and got[71] == 1 and 72 not in got
    assert got[69] == got[68] == got[70] == 1, "texts without words are copies of nothing"
    assert got[5] == 1, "rows repeated in full stay once"


# Language

def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = op6.identify(docs, op6.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    out = got.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert out[0] > 0.97 and 0 <= out[1] <= out[2] <= 1


def test_temperature_makes_probabilities_honest():
    rng = np.random.default_rng(2)
    p = rng.dirichlet([1, 1, 1], 4000)
    truth = [int(rng.choice(3, p=q)) for q in p]
    assert op6.fitted_temperature(list(3 * np.log(p)), truth) == pytest.approx(3, rel=0.15)


def test_undecided(spark):
    model = op6.Model(["de", "en"], np.ones(1 << op6.BITS), np.zeros((2, 1 << op6.BITS), np.float32), 1.0)
    assert model.predict("abc") == ("de", 0.5) and model.predict("12 !") == model.predict(None) == ("und", 0.0)
    assert op6.Model([], np.ones(2), np.zeros((0, 2)), 1.0).predict("abc") == ("und", 0.0)


# HTML

@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"),
    ("<p>One<p>Two <b>bold</b>\n three<br>four</p>", "One\nTwo bold three four"),
    ("<article><header><h1>Title</h1></header><p>a &lt; b &amp;amp; &#233;</p><footer>f</footer></article><p>out", "Title\na < b &amp; é"),
    ("<header>h</header><main><div class='promo box'>x</div><p id=ad-1>x</p><p>In</p><section class=comments>x</section></main>", "In"),
    ("<body class='page-sidebar'><div hidden>x</div><p>Shown<script>var a='</p>'</script></p><form><p>x</form><!-- <p>x</p> -->", "Shown"),
    ("<article><p>a</p></article><aside><article>x</article></aside><article class=comment>x</article><article>b</article>", "a\nb"),
    ("<ul><li>one<li>two<ul><li>three</ul><li>four</ul><table><tr><td>a<td>b<tr><th>c</table>", "one\ntwo\nthree\nfour\na\nb\nc"),
    ("<p>open <a href='x>y'>link</a> <i>never closed", "open link never closed"),
    ("a<!-- never closed <p>lost", "a"), ("<div>" * 5000 + "deep", "deep"),
])
def test_main_text(html, text):
    assert main_text(Page(html), set()) == text


def test_site_templates_go(spark):
    notice = "<div><p>Join our club today</p></div>"
    page = lambda i, host: (i, f"https://{host}/{i}", f"<article><p>Story {i} of many words</p>{notice if host == 'a.example' else ''}<p>End {i % 40}</p></article>")
    rows = [page(i, "a.example") for i in range(40)] + [page(100 + i, "b.example") for i in range(3)] + [(999, "https://b.example/x", f"<article><p>Own</p>{notice}</article>")]
    rows += [(200 + i, f"https://c.example/{i}", "<article><p>Copied story</p><p>Its end</p></article>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in op8.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7] == "Story 7 of many words\nEnd 7" and got[999] == "Own\nJoin our club today"
    assert got[210] == "Copied story\nIts end", "copies of one article count once"
    assert got[101] == "Story 101 of many words\nEnd 21"


# Licenses

def test_template_automata():
    a = op9.Automaton("one <<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> four <<var;words=2>> five")
    ends = lambda text: [(s, e) for s, e in a.find(op9.words_of(text), b" " + b" ".join(op9.words_of(text)) + b" ")]
    assert ends("x one four five") == [(1, 4)] and ends("One, TWO four a b five!") == [(0, 6)]
    assert ends("one two three four five five") == [(0, 6)], "the longest match counts"
    assert ends("one three four five") == ends("one four a b c five") == ends("four five") == []
    for bad in ("<<beginOptional>>x", "<<what>> x", "<<beginOptional>>x<<endOptional>>"):
        with pytest.raises(ValueError):
            op9.Automaton(bad)


def test_license_places(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3.", None, None), (2, "cc by, CC-BY; ccby cc  by-nc", None, None),
            (3, "GNU general public\nlicense é", None, None), (4, "Licensed under the Apache License, Version 2.0.", None, None)]
    got = {r["doc_id"]: r for r in op9.scan(frame(spark, rows)).collect()}
    found = {i: sorted((m["label"], m["first"], m["last"], m["base"]) for m in r["matches"]) for i, r in got.items()}
    assert found[1] == [("gpl", 6, 9, True), ("gpl-3.0", 3, 11, False)]
    assert [m[1] for m in found[2]] == [0, 2, 5] and got[2]["n_words"] == 8
    assert found[3] == [("gpl", 0, 3, True)] and got[3]["n_words"] == 5
    assert ("apache-2.0", 0, 7, False) in found[4] and ("apache", 3, 4, True) in found[4]


# Language models

@pytest.mark.parametrize("hot,bits,chunk", [(op10.HOT, op10.FIELD_BITS, op10.CHUNK), (2_000, 8, 5_000), (0, 20, 300)])
def test_losses_against_plain_counts(spark, small, monkeypatch, hot, bits, chunk):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rows = op10.marked(docs, labels)
    texts = [(r["doc_id"], r["text"], r["target"], r["background"]) for r in rows.collect()]
    everything = {t for x in texts for t in tokens(x[1])}
    monkeypatch.setattr(op10.counted, "__defaults__", (chunk,))
    rows = op10.split(rows)
    models = op10.train(rows, hot, bits)
    rare = models.rare.count()
    assert models.vocabulary == len(everything) and len(models.hot) <= hot
    assert (len(models.hot) > 0, rare > 0) == (hot > 0, hot < op10.HOT)
    single, pairs, of = ([None, None, Counter(), Counter()] for _ in range(3))
    for which in (2, 3):
        for x in texts:
            if x[which]:
                found = tokens(x[1])
                single[which].update(found); pairs[which].update(zip(found, found[1:])); of[which].update(found[:-1])

    def loss(found, which, counted):
        less = [Counter(c) if counted else Counter() for c in (found, zip(found, found[1:]), found[:-1])]
        n, total, last = sum(single[which].values()) - counted * len(found), 0.0, None
        for w in found:
            p = (single[which][w] - less[0][w] + op10.ADDED) / (n + op10.ADDED * len(everything))
            if last is not None:
                p = (pairs[which][last, w] - less[1][last, w] + op10.PRIOR * p) / (of[which][last] - less[2][last] + op10.PRIOR)
            total, last = total - math.log2(p), w
        return total / len(found)

    plain = []
    for doc_id, text, target, background in texts:
        found = tokens(text)
        plain.append((doc_id, len(found), *((loss(found, 2, target), loss(found, 3, background)) if found else (None, None))))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted([tuple(r)[:4] for r in op10.cross_entropy_difference(rows, models).collect()], key=order)
    for mine, theirs in zip(got, sorted(plain, key=order), strict=True):
        assert mine[:2] == theirs[:2] and mine[2:] == (theirs[2:] if theirs[2] is None else pytest.approx(theirs[2:], abs=1e-8))


def test_small_shares_are_sampled(spark):
    docs = spark.range(400_000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    assert op10.marked(docs.filter("doc_id < 300000"), labels).filter("target").count() == 1
    labels = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert 15 <= op10.marked(docs, labels).filter("background").count() <= 80


# Pipeline

def test_stages_keep_columns_and_take_effect(spark, small):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(p.STAGES):
        docs = p.staged(stage(spark, docs, small), "test")
        assert docs.columns == spark.read.parquet(f"{small}/documents.parquet").columns, name
        seen[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    after = [set(seen[n]) for n, _ in p.STAGES]
    assert not after[0] & {63, 64} and not after[1] & {60, 61, 62, 72}
    assert {65, 66} <= after[2] and not after[3] & {65, 66} and after[4] <= after[3]
    assert max(seen["mixing sources"].values()) <= 2
    assert {r["doc_id"] for r in p.run(spark, small).select("doc_id").collect()} == after[4]
