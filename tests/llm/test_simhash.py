"""SimHash groups against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from wardscope.llm import catalog
from wardscope.llm.simhash import fingerprint, keep_one, links, near_groups, spanning_links


def plain_print(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + width]) for i in range(max(len(words) - width + 1, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, max_bits=4):
    """Smallest index reachable for each print, by comparing all pairs."""
    prints = np.array(prints, dtype=np.uint64)
    label = np.arange(len(prints))
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= max_bits)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("text", [None, "", " \n\t ", "One", "one two three", "A b C d e A b C d É x", "x y " * 300])
def test_fingerprint(text):
    assert fingerprint(text) == plain_print(text)


def test_groups_of_documents(spark, small):
    rows = catalog.table(spark, small, "documents").select("doc_id", "text").collect()
    rows.sort()
    groups = plain_groups([plain_print(r.text) for r in rows])
    expected = {r.doc_id: (f"{plain_print(r.text):016x}", rows[g].doc_id) for r, g in zip(rows, groups)}
    got = catalog.QUERIES["op9_simhash_groups"](spark, small).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == expected and len(got) == len(rows)


@pytest.mark.parametrize("tile", [3, 50, 4096])
def test_no_link_is_lost_in_a_large_group(spark, tile):
    draw = random.Random(7)
    centre = [draw.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for c in centre for _ in range(60)} | {0, (1 << 64) - 1}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    found = links(frame, 4, 6, tile).collect()
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in found:
        assert ((u ^ v) & ((1 << 64) - 1)).bit_count() > 0
        a, b = top(u % (1 << 64)), top(v % (1 << 64))
        parent[max(a, b)] = min(a, b)
    assert [top(p) for p in prints] == [prints[g] for g in plain_groups(prints)]


def test_spanning_links_are_fewer_than_prints():
    prints = np.array([1 << k for k in range(64)], dtype=np.uint64)
    assert sum(len(found) for found, _ in spanning_links(prints, 4)) == 63


def test_nulls_ties_and_other_columns(spark):
    frame = spark.createDataFrame([(5, None, 1), (3, "", 2), (3, "", 3), (None, "a b c d e f g h", 4), (9, "A b c d e f g h", 5)],
                                  "doc_id long, text string, print int")
    got = sorted((r.doc_id or 0, r.component_id) for r in near_groups(frame).collect())
    assert got == [(0, 9), (3, 3), (3, 3), (5, 3), (9, 9)]
    assert near_groups(frame.limit(0)).collect() == []
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9]
    assert keep_one(frame.where("doc_id IS NULL")).count() == 1
