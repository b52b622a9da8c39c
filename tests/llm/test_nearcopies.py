"""Near copies against exact similarities of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from wardscope.llm import catalog
from wardscope.llm.nearcopies import band_keys, keep_one, shingles, similar_links


def plain_sets(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, min(len(words), 1)))}


def plain_kept(rows):
    """Smallest id of every group that pairs of similarity 0.8 or more connect."""
    rows = sorted(rows)
    sets, root = [plain_sets(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 9 * len(a & sets[j]) >= 4 * (len(a) + len(sets[j])):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {rows[k][0] for k in range(len(rows)) if root[k] == k}


def edited(words, changes, draw):
    words = list(words)
    for k in draw.sample(range(len(words)), changes):
        words[k] = f"new{draw.randrange(10**9)}"
    return " ".join(words)


def planted():
    draw = random.Random(3)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(base)] + [edited(base, draw.randint(1, 12), draw) for _ in range(8)]
    return list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "one two")]


@pytest.mark.parametrize("tile", [3, 1024])
def test_stage_against_all_pairs(spark, tile):
    rows = planted()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in keep_one(frame, tile=tile).collect()} == plain_kept(rows)
    stage = corpus_pipeline.keep_one_of_near_copies(spark, frame, "")  # the 4 bits of op9 left most of these copies
    assert {r.doc_id for r in stage.collect()} == plain_kept(rows)


def test_documents(spark):
    docs = catalog.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert {r.doc_id for r in keep_one(docs).collect()} == plain_kept(rows)


def test_ids_that_repeat_or_lack(spark):
    frame = spark.createDataFrame([(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y"), (None, "X y")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text.lower()) for r in keep_one(frame).collect()) == [(0, "x y"), (5, "a b c d e f g")]
    assert keep_one(frame.limit(0)).count() == 0


def test_links_and_keys():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(40, size=110)) for _ in range(60)]
    links = similar_links(list(range(60)), sets)
    near = {(i, j) for i in range(60) for j in range(i) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j]))}
    assert near and all((max(l), min(l)) in near for l in links)
    label = list(range(60))
    for _ in range(60):
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
    assert all(label[i] == label[j] for i, j in near)
    trials = [np.unique(draw.integers(1 << 63, size=400, dtype=np.uint64)) for _ in range(300)]  # 320 of 400 in both: similarity 0.8
    met = sum(bool((band_keys(t[:-40], 30, 5) == band_keys(t[40:], 30, 5)).any()) for t in trials)
    assert met == len(trials) and len(shingles("a b c d e f")) == 2


def test_fingerprints_propose_close_copies(spark):
    draw = random.Random(8)
    words = [[f"w{draw.randrange(5000)}" for _ in range(600)] for _ in range(6)]
    rows = list(enumerate([" ".join(w) for w in words] + [" ".join([*w[:-1], "other"]) for w in words]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in keep_one(frame, bands=0).collect()} == set(range(6)) == plain_kept(rows)  # no bands: fingerprints alone
