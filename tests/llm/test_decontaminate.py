"""Contamination against a plain version without hashes, bit maps or joins."""

from __future__ import annotations

import re

import pytest

from wardscope.llm import catalog
from wardscope.llm.decontaminate import UNITS, contamination, pattern


def plain_tokens(text):
    out, start = [], True
    for w in (text or "").split():
        bare = re.sub(r"^[\W_]+|[\W_]+$", "", w)
        title = len(bare) > 1 and bare[0].isupper() and bare[1:].islower()
        measure = re.match(r"\d[\d.,]*([^\W\d_]+)$", bare)
        if not bare:
            kind = None
        elif measure and measure[1].lower() in UNITS:
            kind = "MEASURE"
        elif re.match(r"\d[\d.,:/^-]*%?$", bare):
            kind = "NUMBER"
        elif bare.lower() in UNITS and out and out[-1][0] == "NUMBER":
            kind = "UNIT"
        elif title and not start:
            kind = "NAME"
        else:
            kind = bare.casefold()
        if kind:
            out.append((kind, bare.casefold()))
        start = w.endswith((".", "!", "?", ":"))
    return out


SLOTS = ("MEASURE", "NUMBER", "UNIT", "NAME")


def plain_windows(text, width, whole_below=0, least=5):
    """Start, width, key and tokens of the text for each reading of each window: with all slots, with names as words, word by word."""
    tokens = plain_tokens(text)
    if len(tokens) < whole_below:
        width = len(tokens)
    readings = [SLOTS, ("MEASURE", "NUMBER", "UNIT"), ()] if width >= least else [()]
    for i in range(len(tokens) - width + 1) if width else []:
        for kinds in readings:
            part = [(k if k in kinds else v, v, k in kinds) for k, v in tokens[i:i + width]]
            values = [(k, v) for k, v, slot in part if slot]
            if 2 * len(values) <= width:
                yield i, width, (tuple(k for k, _, _ in part), pattern(values)), len(tokens)


def plain_run(text, items, width=8, min_run=13):
    """Longest stretch of tokens in which every window is known, without regard to slots that clash between windows."""
    known = {}
    for _, t in items:
        for _, w, key, n in plain_windows(t, width, width):
            known[w, key] = min(known.get((w, key), min_run), n)
    best = 0
    start = stop = need = 0
    for i, w, need_here in sorted((i, w, known[w, key]) for ww in {w for w, _ in known} for i, w, key, _ in plain_windows(text, ww) if (w, key) in known):
        if i > stop or not stop:
            start, stop, need = i, 0, need_here
        stop, need = max(stop, i + w), min(need, need_here)
        if stop - start >= need:
            best = max(best, stop - start)
    return best


def test_documents_against_plain_version(spark, small):
    docs = catalog.table(spark, small, "documents").select("doc_id", "text").collect()
    items = [tuple(r) for r in catalog.table(spark, small, "benchmark").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in catalog.QUERIES["op10_benchmark_decontamination"](spark, small).collect()}
    assert {k: r.matched_tokens for k, r in got.items()} == {r.doc_id: plain_run(r.text, items) for r in docs}
    assert any(r.contaminated for r in got.values()) and not all(r.contaminated for r in got.values())


QUESTION = "A train leaves Paris at 9 and travels 120 km before it meets Anna in Paris at noon , how fast was the train moving then ?"
FILLER = "some plain words of another kind that nobody asked about in any test so far"


@pytest.mark.parametrize("text, found", [
    (f"{FILLER} {QUESTION} {FILLER}", True),
    (f"{FILLER} {QUESTION.lower().replace('paris', 'Lyon').replace('anna', 'Berta').replace('9', '7').replace('120', '300')} {FILLER}", True),
    (QUESTION.replace("Paris", "Lyon", 1).replace("in Paris", "in Rome"), False),  # one place became two
    (QUESTION.replace(" ", "\n"), True), (f"*** {QUESTION.upper()}", True), (FILLER, False), (None, False), ("", False),
    ("four words of it", False), ("please compute seven times eight now", True)])
def test_cases(spark, text, found):
    items = spark.createDataFrame([(3, QUESTION), (8, QUESTION), (4, "please compute seven times eight now"), (5, "yes"), (6, None), (None, FILLER)], "item_id long, text string")
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, item_id string")
    (row,) = contamination(docs, items, min_run=20).collect()
    assert row.contaminated == found and (row.item_id is not None) == found and row.item_id in (None, 3, 4)


def test_empty_and_repeated(spark):
    items = spark.createDataFrame([(3, QUESTION)], "item_id long, text string")
    docs = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (None, QUESTION), (2, None)], "doc_id long, text string")
    assert sorted(r.contaminated for r in contamination(docs, items).collect()) == [False, True, True, True]
    assert contamination(docs.limit(0), items).count() == 0
    assert [r.contaminated for r in contamination(docs, items.limit(0)).collect()] == [False] * 4
