"""Packing: every id once, no gaps, little padding; the linear program against known optima."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardscope.llm import catalog
from wardscope.llm.packing import column_generation, pack, place, plan, sequences


def check_places(rows, capacity=2048):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append(r)
    for own in at.values():
        own.sort(key=lambda r: r.offset)
        stop = 0
        for r in own:
            assert r.offset == stop
            stop += r.length
        assert stop <= capacity
        assert all(r.padded_length == (stop if stop & (stop - 1) == 0 else capacity) for r in own)
    assert sorted(at) == list(range(len(at)))
    return len(at)


def test_documents_come_back_whole(spark, small):
    docs = {r.doc_id: r.text for r in catalog.table(spark, small, "documents").select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op1_packing"](spark, small).collect()
    plain = Tokenizer.from_file(catalog.tokenizer(catalog.BYTE_BPE))
    own = defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
    assert set(own) == set(docs)
    for key, text in docs.items():
        ids = plain.encode(text, add_special_tokens=False).ids + [1]
        stop = 0
        for r in sorted(own[key], key=lambda r: r.start):
            assert r.start == stop and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[stop:stop + r.length], dtype="<u4").tobytes())
            stop += r.length
        assert stop == len(ids)
    used = check_places(rows)
    assert used <= 1.03 * sum(r.length for r in rows) / 2048 + 2


def test_nulls_repeats_and_joined_ids(spark):
    path = catalog.tokenizer(catalog.BYTE_BPE)
    frame = spark.createDataFrame([(1, None, 0), (1, None, 0), (2, "", 0), (None, "a b", 0), (3, "a word " * 3000, 0)], "doc_id long, text string, length int")
    packed = pack(frame, path, with_ids=True)
    rows = packed.collect()
    check_places(rows)
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 3), (1, 1), (1, 1), (2, 1), (3, 6002)]
    joined = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    assert all(joined[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in rows)
    assert pack(frame.limit(0), path).collect() == []


@pytest.mark.parametrize("buckets", [1, 7])
def test_layout_of_buckets_loses_nothing(spark, small, buckets):
    docs = catalog.table(spark, small, "documents").select("doc_id", "text")
    rows = pack(docs, catalog.tokenizer(catalog.BYTE_BPE), buckets=buckets).collect()
    check_places(rows)
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows)


def test_column_generation_reaches_known_optima():
    sizes, demand = np.array([3, 5, 7]), np.array([30, 30, 30])
    _, use = column_generation(sizes, demand, 15, gap=0.0)
    assert abs(use.sum() - 30.0) < 0.05  # each sequence can hold one of each
    sizes, demand = np.array([34, 50, 67]), np.array([100, 10, 100])
    _, use = column_generation(sizes, demand, 100, gap=0.0)
    assert abs(use.sum() - 155.0) < 0.05  # 67 alone, 50 in twos, 34 in twos


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_item_once(seed):
    draw = np.random.default_rng(seed)
    sizes = np.concatenate((draw.integers(1, 100, 400), draw.integers(1, 513, 300) // 8 * 8 + 8)).clip(1, 512)
    histogram = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
    ranks = np.zeros(len(sizes), dtype=np.int64)
    for s in histogram:
        ranks[sizes == s] = np.arange(histogram[s])
    sequence, slot = place(sizes, ranks, plan(histogram, 512))
    assert len(set(zip(sequence.tolist(), slot.tolist()))) == len(sizes)
    assert np.bincount(sequence, weights=sizes).max() <= 512
    assert sequence.max() + 1 <= 1.05 * sizes.sum() / 512 + 2
