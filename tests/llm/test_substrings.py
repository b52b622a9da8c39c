"""Repeated passages against a plain version that keeps all windows in one dictionary."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from wardscope.llm import catalog
from wardscope.llm.substrings import GEAR, gear_hash, remove_repeats


def plain_windows(text, min_words=20, radius=2, longest=16):
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    if len(words) < min_words:
        return []
    joined, hashes = b"", []
    for w, _, _ in words:
        joined += (b" " if joined else b"") + w.encode()
        h = 0
        for c in joined[-16:]:
            h = (2 * h + int(GEAR[c])) & 0xFFFF
        hashes.append(h)
    n, cuts = len(words), [0]
    for i, h in enumerate(hashes):
        before, after = hashes[max(0, i - radius):i], hashes[i + 1:i + 1 + radius]
        if all(h < x for x in before) and all(h <= x for x in after):
            cuts.append(i + 1)
    cuts = sorted({*cuts, n})
    cuts = [a + k for a, b in zip(cuts, cuts[1:]) for k in range(0, b - a, longest)] + [n]
    found = []
    for a in cuts[:-1]:
        b = next((c for c in cuts if c >= a + min_words), None)
        if b:
            found.append((" ".join(w for w, _, _ in words[a:b]), words[a][1], words[b][1] if b < n else len(text)))
    return found


def plain_repeats(rows):
    places = {}
    for key, text in sorted(rows):
        for w, a, b in plain_windows(text):
            places.setdefault(w, []).append((key, a, b))
    out = {}
    for key, text in rows:
        gone, hit = set(), False
        for all_of in places.values():
            if len(all_of) > 1:
                hit |= any(p[0] == key for p in all_of)
                for k, a, b in all_of[1:]:
                    if k == key:
                        gone |= set(range(a, b))
        out[key] = ("".join(c for i, c in enumerate(text) if i not in gone) if text is not None else None, len(gone), hit)
    return out


def words(draw, n):
    return " ".join("".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 8))) for _ in range(n))


def test_gear_hash_rolls():
    data = np.frombuffer(bytes(range(200)), dtype=np.uint8)
    value = 0
    for k, h in enumerate(gear_hash(data)):
        value = sum(int(GEAR[data[k - j]]) << j for j in range(min(16, k + 1))) & 0xFFFF
        assert h == value


def test_against_plain_version(spark):
    draw = random.Random(3)
    shared = [words(draw, 60) for _ in range(4)]
    rows = [(k, "\n".join([words(draw, draw.randint(1, 60)), shared[k % 4], words(draw, draw.randint(1, 60))])) for k in range(12)]
    rows += [(20, words(draw, 300)), (21, None), (22, ""), (23, "same " * 100), (24, "same " * 80), (25, shared[0] + " " + shared[0]), (26, "ab cd")]
    got = {r.doc_id: (r.text, r.removed_chars, r.repeated) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_repeats(rows)
    assert all(got[k][2] for k in range(12)) and not got[20][2]


def test_documents_against_plain_version(spark, small):
    rows = [tuple(r) for r in catalog.table(spark, small, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.text, r.removed_chars, r.repeated) for r in catalog.QUERIES["op7_substring_dedup"](spark, small).collect()}
    assert got == plain_repeats(rows)


def test_passages_over_fifty_words_are_found():
    draw = random.Random(5)
    missed = 0
    for _ in range(300):
        passage = words(draw, 51)
        keys = [{w for w, _, _ in plain_windows(f"{words(draw, draw.randint(1, 40))} {passage} {words(draw, draw.randint(1, 40))}")} for _ in range(2)]
        missed += not keys[0] & keys[1]
    assert missed <= 3


@pytest.mark.parametrize("copies", [2, 5])
def test_repeated_rows_and_other_columns(spark, copies):
    text = words(random.Random(1), 100)
    frame = spark.createDataFrame([(1, text, "x", 5)] * copies + [(None, text, "y", 6)], "doc_id long, text string, repeated string, row int")
    got = remove_repeats(frame)
    assert got.columns == ["doc_id", "text", "row", "removed_chars", "repeated"]
    texts = sorted(r.text for r in got.collect())
    assert texts == [""] * copies + [text]
    assert remove_repeats(frame.limit(0)).count() == 0
