"""License scans by template-markup matching.

A template is the wording of a notice with marked regions: text between
``<<beginOptional>>`` and ``<<endOptional>>`` may be absent, ``<<var;words=N>>``
stands for any 0 to N words. Each template is compiled once into an automaton
over words. A text is accepted where the automaton consumes consecutive words
from a start to an accepting state: all mandatory words, exactly and in order.
The longest match at each start counts. Case (A-Z), punctuation and line
breaks never matter, as words are runs of what is not ASCII punctuation.

Beside the templates, fixed phrases are found wherever their words stand
consecutively. A template is run only on texts that hold its longest mandatory
phrase, which no accepted text can lack.

Cases: null and empty texts have no words, no labels and score 0. Overlapping
places all count. Repeated rows give repeated results; further columns of the
input are ignored. Texts are processed whole, one at a time, inside tasks;
nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_before, as_text, objects, small_batches, table

# The phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices in common use, by label.
TEMPLATES = [
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License");
        you may not use this file except in compliance with the License<<endOptional>>"""),
    ("gpl-2.0", """licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> version 2 <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>or (at your option) any later version<<endOptional>>"""),
    ("gpl-3.0", """licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>or (at your option) any later version<<endOptional>>"""),
    ("gpl-redistribution", """This program is free software<<beginOptional>>: you can redistribute it and/or
        modify it<<endOptional>> under the terms of the GNU General Public License
        as published by the Free Software Foundation"""),
    ("cc-by-4.0", """licensed under <<beginOptional>>a Creative Commons Attribution<<endOptional>> CC BY 4.0"""),
    ("cc-by-nc-4.0", """licensed under <<beginOptional>>a Creative Commons Attribution NonCommercial
        <<endOptional>> CC BY-NC 4.0"""),
    ("cc-by-sa-4.0", """licensed under <<beginOptional>>a Creative Commons Attribution ShareAlike
        <<endOptional>> CC BY-SA 4.0"""),
    ("mit", """<<beginOptional>>Released<<endOptional>><<beginOptional>>licensed<<endOptional>> under the
        <<beginOptional>>terms of the<<endOptional>> MIT License"""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;words=12>> to deal in <<var;words=4>> without restriction"""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met"""),
    ("all-rights-reserved", """All rights reserved"""),
]

# A-Z to a-z; of the other ASCII characters only 0-9 and a-z stay. Bytes over 0x7F belong to words.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TO_WORDS).split() if text else []


class Automaton:
    """Words from state to state; ``None`` stands for any word."""

    def __init__(self, template: str) -> None:
        self.steps: list[dict[bytes | None, int]] = [{}]
        self.free: list[set[int]] = [set()]
        runs: list[list[bytes]] = [[]]
        opened: list[int] = []
        for part in re.split(r"(<<.*?>>)", template):
            if part == "<<beginOptional>>":
                opened.append(self._state())
                self.free[-2].add(opened[-1])
                runs.append([])
            elif part == "<<endOptional>>":
                last = self._state()
                self.free[last - 1].add(last)
                self.free[opened.pop()].add(last)
                runs.append([])
            elif variable := re.fullmatch(r"<<var;words=(\d+)>>", part):
                begin = len(self.steps) - 1
                for _ in range(int(variable[1])):
                    state = self._state()
                    self.steps[state - 1][None] = state
                end = self._state()
                for state in range(begin, end):
                    self.free[state].add(end)
                runs.append([])
            elif part.startswith("<<"):
                raise ValueError(f"unknown markup {part}")
            else:
                for word in words_of(part):
                    state = self._state()
                    self.steps[state - 1][word] = state
                    if not opened:
                        runs[-1].append(word)
        if opened:
            raise ValueError("an optional region is not closed")
        self.anchor = b" " + b" ".join(max(runs, key=len)) + b" "
        if not self.anchor.strip():
            raise ValueError("a template needs mandatory words")
        self.reach = [self._closure(s) for s in range(len(self.steps))]
        self.firsts = {w for s in self.reach[0] for w in self.steps[s]}

    def _state(self) -> int:
        self.steps.append({})
        self.free.append(set())
        return len(self.steps) - 1

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    def match(self, words: list[bytes], start: int) -> int | None:
        """Where the longest match from ``start`` ends (exclusive)."""
        last, states, end = len(self.steps) - 1, self.reach[0], None
        for at in range(start, len(words) + 1):
            if last in states:
                end = at
            if at == len(words) or not states:
                break
            states = {x for s in states for key in (words[at], None)
                      if (after := self.steps[s].get(key)) is not None for x in self.reach[after]}
        return end

    def find(self, words: list[bytes], joined: bytes) -> Iterator[tuple[int, int]]:
        if self.anchor in joined:
            for start, word in enumerate(words):
                if (word in self.firsts or None in self.firsts) and (end := self.match(words, start)) is not None:
                    yield start, end


def compiled(templates: Iterable[tuple[str, str]] = TEMPLATES) -> list[tuple[str, Automaton]]:
    return [(label, Automaton(text)) for label, text in templates]


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word indexes at which a phrase starts; ``joined`` has one space around every word."""
    at, index, counted = joined.find(phrase), 0, 0
    while at >= 0:
        index += joined.count(b" ", counted, at)
        counted = at
        yield index
        at = joined.find(phrase, at + 1)


MATCHES = "array<struct<label:string,first:bigint,last:bigint,base:boolean>>"


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: Iterable[tuple[str, str]] = tuple(TEMPLATES)) -> DataFrame:
    """(doc_id, n_words, matches) for every row; a match is its label and first and last word."""
    small_batches(docs.sparkSession)
    fixed = [(b" " + b" ".join(words_of(p)) + b" ", label) for p, label in phrases.items()]

    def scan_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata = compiled(templates)
        for batch in batches:
            counts, found = [], []
            for text in batch["text"]:
                words = words_of(text)
                joined = b" " + b" ".join(words) + b" "
                hits = [(label, at, at + phrase.count(b" ") - 2, True) for phrase, label in fixed for at in places(joined, phrase)]
                hits += [(label, start, end - 1, False) for label, a in automata for start, end in a.find(words, joined)]
                counts.append(len(words))
                found.append([dict(zip(("label", "first", "last", "base"), h)) for h in hits])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": counts, "matches": objects(found)})

    found = as_text(docs.select("doc_id", "text"), "doc_id").mapInPandas(scan_texts, f"doc_id string, n_words bigint, matches {MATCHES}")
    return as_before(found, docs, "doc_id")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m.getField("base"))
    starts = F.transform(base, lambda m: m.getField("first"))
    labels = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda m: m.getField("label")))), ",")
    exact = F.exists("matches", lambda m: ~m.getField("base"))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        # 1: a whole template stands in the text; 0.5: only a phrase does.
        F.when(exact, 1.0).when(F.size("matches") > 0, 0.5).otherwise(0.0).alias("score"))
