"""Quality counts and host verdicts."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from tests.compare import difference
from wardscope.llm import catalog
from wardscope.llm.quality import quality_rules, text_counts


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("text", [None, "", " \n", "a", "a b", "a b c", "a b c a b c", "x x x x", "é# $\x85 b\x1cc\nd\n d\nd",
                                  "a b c d e a b c x a b\nline\nline\n\n", "w " * 5000, " ".join(f"w{k % 997}" for k in range(20000))])
def test_counts(text):
    assert text_counts(text) == plain_counts(text)


def test_query_matches_sql(spark, duck, small):
    assert difference(spark, duck, small, catalog.QUERIES["op6_quality_rules"], catalog.ORACLES["op6_quality_rules"]) is None


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "bad" if k < 60 else "fine", good if k >= 55 else "short", k) for k in range(200)] + [(200, None, good, 0), (201, None, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, kept int")
    got = {r.doc_id: r for r in quality_rules(frame).collect()}
    assert len(got) == 202
    assert not any(got[k].kept for k in range(60)) and all(got[k].kept for k in range(60, 201)) and not got[201].kept
    assert not got[57].base_failed and got[57].host_rate > 0.5 and got[200].host_rate is None
    assert got[60].host_rate < 0.1


def test_equal_hosts_are_shrunk_to_the_common_rate(spark):
    good = " ".join(f"w{k}" for k in range(60))
    frame = spark.createDataFrame([(k, f"h{k % 4}", good if k % 2 else "") for k in range(400)] + [(401, "once", "")], "doc_id long, source string, text string")
    rates = {r.doc_id: r.host_rate for r in quality_rules(frame).collect()}
    assert rates[401] < 1  # one failure of one document is no proof


def test_empty_and_repeated(spark):
    frame = spark.createDataFrame([(1, "h", None)] * 3, "doc_id long, source string, text string")
    assert [r.kept for r in quality_rules(frame).collect()] == [False] * 3
    assert quality_rules(frame.limit(0)).count() == 0
