"""Each stage against plain versions on its own input; the whole run."""

from __future__ import annotations

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_decontaminate import plain_run
from tests.llm.test_nearcopies import plain_kept
from tests.llm.test_packing import check_places
from tests.llm.test_quality import plain_counts
from tests.llm.test_substrings import plain_repeats
from wardscope.llm import catalog


@pytest.fixture(scope="module")
def results(spark, small):
    docs, found = catalog.table(spark, small, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small).cache()
        found.append(docs)
    return found


def test_columns(spark, small, results):
    names = catalog.table(spark, small, "documents").dtypes
    assert all(r.dtypes == names for r in results[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "packing"]


def test_stages(spark, small, results):
    before = {r.doc_id: r for r in catalog.table(spark, small, "documents").collect()}
    good, single, cut, clean = ({r.doc_id: r for r in f.collect()} for f in results[:4])
    counts = {k: plain_counts(r.text) for k, r in before.items()}
    assert set(good) == {k for k, c in counts.items() if c[0] >= 50 and 100 * c[4] <= 50 * c[0]}  # no host here is bad
    assert set(single) == plain_kept([(k, r.text) for k, r in good.items()])  # five-word shingles, similarity of 0.8 or more
    rest = plain_repeats([(k, r.text) for k, r in single.items()])
    assert {k: r.text for k, r in cut.items()} == {k: t for k, (t, _, _) in rest.items()}
    assert all(r.n_chars == len(r.text) for r in cut.values())
    items = [tuple(r) for r in catalog.table(spark, small, "benchmark").select("item_id", "text").collect()]
    assert set(clean) == {k for k, r in cut.items() if not plain_run(r.text, items)}
    rows = results[4].collect()
    check_places(rows)
    assert {r.doc_id for r in rows} == set(clean)


def test_run_is_registered_and_ends_alike(spark, small, results):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in rows) == sorted((r.doc_id, r.start, r.ids_crc32) for r in results[4].collect())
    assert np.mean([r.length for r in rows]) > 0
