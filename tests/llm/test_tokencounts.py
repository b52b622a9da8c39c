"""Tokens of sections against the offsets that the library gives."""

from __future__ import annotations

from collections import Counter

import pytest
from tokenizers import Tokenizer

from wardscope.llm import catalog
from wardscope.llm.tokencounts import section_tokens


def plain_sections(text, rule, path, given=None):
    text = text or ""
    starts = [0] + ([i + 1 for i, c in enumerate(text) if c == "\n"] if given is None else sorted({c for c in given if c and 0 < c < len(text)}))
    home = [max(k for k, s in enumerate(starts) if s <= i) for i in range(len(text))]
    tokens, crossing = Counter(), Counter()
    for a, b in Tokenizer.from_file(path).encode(text, add_special_tokens=False).offsets:
        sizes = Counter()
        for i in range(a, b):
            sizes[home[i]] += len(text[i].encode())
        first, last = home[a], home[b - 1]
        own = first if rule == "first" else last if rule == "last" else max(sizes, key=lambda k: (sizes[k], -k))
        tokens[own] += 1
        crossing[own] += first != last
    ends = [*starts[1:], len(text)]
    return [(k, s, e - s, tokens[k], crossing[k]) for k, (s, e) in enumerate(zip(starts, ends))]


def test_documents(spark, small):
    path = catalog.tokenizer(catalog.BYTE_BPE)
    docs = catalog.table(spark, small, "documents").where("length(text) < 4000").select("doc_id", "text").collect()
    got = catalog.QUERIES["op8_token_counts"](spark, small).collect()
    own = {}
    for r in sorted(got):
        own.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert all(own[d.doc_id] == plain_sections(d.text, "first", path) for d in docs)


@pytest.mark.parametrize("name", [catalog.BYTE_BPE, catalog.WORD_BPE])
@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_rules_and_given_sections(spark, rule, name):
    path = catalog.tokenizer(name)
    rows = [(1, "unbelievable words\n\n\nthere é日本語", [3, 7, 19, None, 500, 20, 25]), (2, None, None), (3, "", [1]), (4, "a\nb\n", []), (4, "a\nb\n", [])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, section array<int>")
    for sections in (None, "section"):
        got = sorted(tuple(r) for r in section_tokens(frame, path, rule=rule, sections=sections).collect())
        assert got == sorted((k, *s) for k, t, g in rows for s in plain_sections(t, rule, path, (g or []) if sections else None))
    assert section_tokens(frame.limit(0), path).collect() == []
