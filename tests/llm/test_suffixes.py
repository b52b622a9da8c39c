"""Removal of earlier strings against plain sets of windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardscope.llm import catalog, suffixes
from wardscope.llm.suffixes import longest_previous, remove_earlier, runs, suffix_order


def plain(rows, length=50):
    """Expected rows of texts in ascending order of their ids."""
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        own = [raw[i:i + length] for i in range(len(raw) - length + 1)]
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i, w in enumerate(own):
            if w in seen:
                gone[i:i + length] = True
        seen.update(own)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if raw else 0
        out.append((doc_id, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    draw = random.Random(11)
    vocabulary = ["alpha", "beta", "gamma", "été", "日本", "x", "\n", "delta-epsilon", "0000000000"]
    made = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 120))) for _ in range(60)]
    passage = "".join(draw.choices("abcdefghijklmnop ", k=400))
    for k in (49, 50, 51, 77, 400):
        made += [f"{draw.random()} {passage[:k]} {draw.random()}", f"{draw.random()}{passage[400 - k:]}{draw.random()}"]
    made += ["a" * 1000, "b" + "a" * 300, "ab" * 700, "a" * 49, "a" * 50, "", None, None, passage[:50], passage, passage]
    made += [made[5][:200] + "Z" + made[5][200:], made[5], made[6] + made[7], passage + passage, "é" * 30, "é" * 24 + "e"]
    line = "this licence line is found in most of the documents of the table. "
    made += [f"{draw.random()} {line} {draw.random()} {draw.random()}" for _ in range(60)]
    draw.shuffle(made)
    return made


def got_rows(frame):
    return sorted(tuple(r) for r in frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("options", [{}, {"most": 5}, {"bucket_bytes": 2000, "limit": 100, "flush": 1500, "rows": 10, "most": 20}])
def test_against_plain_windows(spark, options):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, code string").repartition(5)
    assert got_rows(remove_earlier(frame, **options)) == plain(rows)
    assert sum(r[2] > 0 for r in plain(rows)) > 60


def test_other_lengths(spark):
    rows = [(i, t and t[:120]) for i, t in enumerate(texts())][:60]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    for length in (3, 20):
        assert got_rows(remove_earlier(frame, length=length)) == plain(rows, length)


def test_ids_may_repeat_or_lack(spark):
    same = "one passage that is a good deal longer than the fifty bytes of a window"
    frame = spark.createDataFrame([(7, same), (7, same), (None, same), (1, None)], "doc_id long, text string").coalesce(1)
    got = remove_earlier(frame).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == [(0, 71, 71), (1, 0, 0), (7, 71, 0), (7, 71, 71)]
    assert remove_earlier(frame.limit(0)).collect() == []


def test_query_on_the_table(spark, small):
    rows = sorted(tuple(r) for r in catalog.table(spark, small, "documents").select("doc_id", "text").collect())
    got = catalog.QUERIES["op12_suffix_dedup"](spark, small)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got_rows(got) == plain(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", min_size=4, max_size=4)), max_size=30))
def test_longest_previous_factors(items):
    data = np.frombuffer("".join(t for _, t in items).encode(), dtype=np.uint8)
    value = np.array([v for v, _ in items], dtype=np.int64)
    if not items:
        assert len(longest_previous(value, value)) == 0
        return
    order, lcp = suffix_order(data, np.arange(len(items)) * 4, value, 4)
    assert [items[i] for i in order] == [items[i] for i in sorted(order, key=lambda i: (items[i][1], items[i][0]))]

    def shared(a, b):
        return next((k for k in range(4) if a[k] != b[k]), 4)

    for least in (1, 3):
        found = longest_previous(value[order], lcp, least)
        for i, f in zip(order, found):
            best = max([shared(items[i][1], t) for v, t in items if v < items[i][0]], default=0)
            assert f == (best if best >= least else 0)


def test_equal_windows_have_equal_codes():
    draw = random.Random(2)
    parts = [(i, 0, "".join(draw.choices("ab ", k=draw.randint(0, 200))).encode()) for i in range(40)]
    found = runs(parts, 3, 10)
    code, text = {}, dict((p[0], p[2]) for p in parts)
    for c, n, row, start in zip(found.code.tolist(), found.windows.tolist(), found.row.tolist(), found.start.tolist()):
        assert n <= suffixes.LONGEST_RUN
        for k in range(n):
            assert code.setdefault(text[row][start + k:start + k + 10], c) == c
    assert found.windows.sum() == sum(max(len(p[2]) - 9, 0) for p in parts)
