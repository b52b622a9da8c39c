"""Every registered query against its SQL twin, and a rows check for the others."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import difference

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()
SLOW = {"g3_stage3", "g4_count_forecast", "g6_type_classifier"}  # covered by test_jobs


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, small, name):
    assert difference(spark, duck, small, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_gives_rows(spark, small, name):
    # Fifteen keys of the smallest tables lie too far apart for any edge, so that walks have no nodes there.
    assert QUERIES[name](spark, small).count() > 0 or name == "m5b_walk_embeddings"


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 12


def test_all_oracles_are_queries():
    assert set(ORACLES) <= set(QUERIES)
