"""Code lengths against a plain context tree, and accuracy on what was held out."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wardscope.llm import catalog
from wardscope.llm.langid import ORDER, Trees, grams, identify, training_sample, tree


def plain_bits(train, text):
    seen = defaultdict(Counter)
    for t in train:
        t = b"\n" * ORDER + t
        for i in range(ORDER, len(t)):
            for k in range(ORDER + 1):
                seen[k, t[i - k:i]][t[i]] += 1
    total, text = 0.0, b"\n" * ORDER + text
    for i in range(ORDER, len(text)):
        for k in range(ORDER, -1, -1):
            own = seen.get((k, text[i - k:i]))
            if own is None:
                continue
            all_of = sum(own.values()) + len(own)
            if text[i] in own:
                total -= math.log2(own[text[i]] / all_of)
                break
            total -= math.log2(len(own) / all_of)
        else:
            total += 8
    return total


def model(texts):
    parts = [(name, d, k, c, b) for name, own in texts.items() for d, k, codes, bits in tree(own) for c, b in zip(codes.tolist(), bits.tolist())]
    return Trees(pa.table(dict(zip(("lang", "depth", "kind", "code", "bits"), zip(*parts)))))


@pytest.mark.parametrize("text", ["", "the cat", "zzzé\n\nthe", "a" * 50])
def test_code_lengths(text):
    train = {"x": [b"the cat sat on the mat", "thé é".encode(), b""], "y": [b"abcabcabc"]}
    for name, own in train.items():
        trees = model(train)
        assert trees.bits(grams([text.encode()])[0], name).sum() == pytest.approx(plain_bits(own, text.encode()))
    if text:
        best = min(train, key=lambda n: plain_bits(train[n], text.encode()))
        assert trees.predict([None, text, "12 !", text]) [1:] == [trees.predict([text])[0], ("und", 0.0), trees.predict([text])[0]]
        assert trees.predict([text])[0][0] == best


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(catalog.table(spark, folder, "documents").select("doc_id", "lang").collect())
    rows = catalog.QUERIES["op2_language_id"](spark, folder).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in own]) >= 0.97


def test_nulls_and_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, None, "en", "x"), (2, "word", None, "y"), (None, "word", "de", "z")], "doc_id long, text string, lang string, score string")
    got = identify(frame)
    assert sorted(r.lang_pred for r in got.collect()) == ["und"] * 3 and len(got.columns) == 6
    assert identify(frame.limit(0)).collect() == []


def test_long_texts_are_learned_from_in_pieces(spark):
    french, english = "le chat est sur la table et il mange du pain ", "the cat sat on the mat and ate some bread "
    rows = [(i, french * 2000, "fr") for i in range(12)] + [(100 + i, english * 3, "en") for i in range(40)]
    docs = spark.createDataFrame(rows + [(500, "il est sur la table", None), (501, "ate on the mat", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify(docs).collect()}
    assert {got[i] for i in range(12)} == {"fr"} and {got[100 + i] for i in range(40)} == {"en"} and (got[500], got[501]) == ("fr", "en")


def test_bound_of_the_sample(spark):
    same = spark.range(20_000).selectExpr("7L AS `d.id`", "concat('word ', id % 3) AS text", "'en' AS lang")
    assert training_sample(same, "d.id", "text", "lang", sample_docs=50).count() == 50
    long = spark.createDataFrame([(1, "abc" * 1000, "x"), (2, "", "x")], "id long, text string, lang string")
    pieces = [r.text for r in training_sample(long, "id", "text", "lang", sample_chars=100).collect()]
    assert sorted(map(len, pieces)) == [0] + [100] * 30 and set("".join(pieces)) == set("abc")
    few = [r.text for r in training_sample(long, "id", "text", "lang", sample_docs=5, sample_chars=100).collect()]
    assert len(few) == 5
