"""Phrases against plain counting of strings."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from wardscope.llm import catalog, phrases
from wardscope.llm.fingerprints import HASHES, Bloom, Polynomial, bit_places, bloom_bits, codes, packed_ascending, unpacked_ascending
from wardscope.llm.phrases import collocations, parts_of, words

LETTERS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top=2000):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LETTERS)):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for n in range(1, 5):
                count.update((lang, tuple(ws[i:i + n])) for i in range(len(ws) - n + 1))
    cand = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * a >= 80 * count[lang, p[i:i + m]]:
                    gone.add((lang, p[i:i + m]))
    out = []
    for lang in total:
        found = []
        for (other, p), a in cand.items():
            if other == lang and (lang, p) not in gone:
                score, k = min((2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made_texts():
    draw = random.Random(3)
    vocabulary = ["The", "the", "red", "Red", "fox", "é", "É", "ran", "over", "a b", "x#", "日本", "(so)", "it's"]
    joins = [" ", " ", " ", "  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "\x0b", "!?", " ; "]
    texts = []
    for i in range(120):
        text = "".join(w + draw.choice(joins) for w in draw.choices(vocabulary, k=draw.randint(0, 60)))
        texts.append((draw.choice(["en", "en", "fr", None, "und"]), text + draw.choice(["New York City Hall", "new  york\tcity hall.", "", "  "])))
    return texts + [("en", None), ("en", ""), (None, " \t\n"), ("de", "w" * 3000 + " " + "w" * 3000 + " " + "v"), ("de", "w" * 3000 + " " + "w" * 3000)] * 2


@pytest.mark.parametrize("least, top", [(2, 2000), (5, 7), (10 ** 6, 5)])
def test_against_plain_counting(spark, least, top):
    rows = made_texts()
    frame = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int").repartition(4)
    got = [tuple(r) for r in collocations(frame, least=least, top=top).collect()]
    assert sorted(got) == plain(rows, least, top)
    assert (least > 100) == (not got)


def test_ids_may_repeat_or_lack(spark):
    rows = [("en", "a b c")] * 3 + [("en", "a b")]
    frame = spark.createDataFrame([(i, *r) for i, r in zip([1, 1, None, 2], rows)], "doc_id long, lang string, text string")
    assert sorted(tuple(r) for r in collocations(frame, least=2).collect()) == plain(rows, 2)
    assert collocations(frame.limit(0), least=2).collect() == []


def test_long_texts_are_cut_between_pieces():
    draw = random.Random(1)
    text = "".join(draw.choice("abc  \t.,") for _ in range(3000)).encode() + b"no end " * 300
    parts = [p for group in parts_of([7], [text], 100) for p in group]
    assert b"".join(p[2] for p in parts) == text and len(parts) > 20
    pieces = Counter(p for p in re.split(rb"[.,]", text) if p.strip())
    assert Counter(p for part in parts for p in re.split(rb"[.,]", part[2]) if p.strip()) == pieces
    found = words(parts)
    assert all(text[p:p + 1] not in b" \t.," for p in found.places.tolist())


def test_small_parts_and_flushes_change_nothing(spark, monkeypatch):
    rows = made_texts()
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    whole = phrases.frequent_sequences(frame, "text", "lang", "doc_id", 3)
    small = phrases.frequent_sequences(frame, "text", "lang", "doc_id", 3, most_bits=1 << 15, bucket_bytes=1000, limit=64, flush=50)
    for a, b in zip(whole, small):
        assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("values", [[], [0], [7, 7, 8], [0, 1, 1 << 31, (1 << 32) - 1]])
def test_ascending_numbers_come_back(values):
    assert unpacked_ascending(packed_ascending(np.array(values, dtype=np.uint32))).tolist() == values


def test_fingerprints_tell_equal_texts():
    data = np.frombuffer(b"new york|new york|york new|" + b"ab" * 600 + b"|" + b"ab" * 600, dtype=np.uint8)
    p = Polynomial(4)
    starts, stops = np.array([0, 9, 18, 27, 1228]), np.array([8, 17, 26, 1227, 2428])
    a, b, c, d, e = p.spans(data, p.prefixes(data), starts, stops).tolist()
    assert a == b != c and d == p.spans(data[27:], p.prefixes(data[27:]), np.array([0]), np.array([1200])).tolist()[0]
    assert p.spans(data, p.prefixes(data), np.array([27]), np.array([1227])) == p.spans(data, p.prefixes(data), np.array([1228]), np.array([2428])) and e


@pytest.mark.parametrize("most_bits", [1 << 15, 1 << 20])
def test_filter_holds_what_it_was_given(spark, most_bits):
    held = codes(np.arange(1, 12000, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
    places = bit_places(held).astype(np.int64).tolist()
    bits = bloom_bits(spark.createDataFrame([(p,) for p in places], "place long"), most_bits)
    expected = np.zeros(8 * len(bits), dtype=np.uint8)
    for place in places:
        for k in range(HASHES):
            expected[(place + k * (place >> 32 | 1)) % len(expected)] = 1
    assert bits == np.packbits(expected, bitorder="little").tobytes() and len(bits) <= most_bits // 8
    passes = Bloom(bits)
    assert passes(held).all() and passes(held + np.uint64(1)).mean() < 0.05


def test_query_against_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    got = catalog.QUERIES["op13_phrases"](spark, small)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(catalog.ORACLES["op13_phrases"]).fetchall())
