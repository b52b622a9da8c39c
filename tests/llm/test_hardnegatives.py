"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wardscope.llm import catalog
from wardscope.llm.hardnegatives import Block, first_in_rows, hard_negatives, scores


def plain(rows, is_anchor, positives=5, negatives=3):
    """All pairs in Python integers."""
    used = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if i not in used or (label, vector) < used[i][2]:
            used[i] = (whole, label, (label, vector))
    out = set()
    for a, (va, la, _) in used.items():
        if not is_anchor(a):
            continue
        others = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, (v, label, _) in used.items() if i != a)
        for p, pid in [(-s, i) for s, i, label in others if label == la][:positives]:
            fit = [(-s, i) for s, i, label in others if label != la and 50 * p <= -100 * s <= 95 * p][:negatives]
            out |= {(a, pid, r, n, p, s) for r, (s, n) in enumerate(fit, 1)}
    return out


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("block, anchor_block", [(2048, 512), (7, 3)])
def test_against_all_pairs(spark, block, anchor_block):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], 0 if draw.random() < 0.4 else draw.randint(1, 4)) for i in range(150)]
    rows += [(i, [0.0] * 6, i % 3) for i in range(150, 160)]  # scores of zero, all tied
    rows += [(160, None, 1), (161, [1.0, None, 0.0], 1), (162, [float("nan")] * 6, 1), (163, [float("inf")] * 6, 1), (164, [1.0] * 6, None), (None, [1.0] * 6, 1),
             (165, [], 2), (166, [0.5, 0.5], 2), (3, [9.0] * 6, 9), rows[4], (-10, [0.5] * 6, 0)]
    frame = frame_of(spark, rows).withColumn("score", F.lit("x")).withColumn("part", F.lit(0)).repartition(3)
    got = [tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 10 == 0, block=block, anchor_block=anchor_block).collect()]
    expected = plain(rows, lambda i: i % 10 == 0)
    assert set(got) == expected and len(got) == len(expected) > 50
    assert any(g[4] == 0 for g in got)


def test_no_rows_and_no_anchors(spark):
    frame = frame_of(spark, [(1, [1.0], 0), (2, [1.0], 1)])
    assert hard_negatives(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives(frame, F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives(frame, F.lit(None).cast("boolean")).collect() == []


def test_text_labels_and_other_names(spark):
    frame = spark.createDataFrame([(0, [1.0], "a"), (1, [1.0], "a"), (2, [0.75], "b"), (3, [0.4], "b")], "`my.id` int, v array<double>, `a.b` string")
    got = hard_negatives(frame, F.col("`my.id`") == 0, "my.id", "v", "a.b").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 49152)]


def test_scores_are_exact():
    big = np.array([[2.0 ** 40, 1.0]])
    assert scores(big, np.array([[2.0 ** 20, 3.0]]))[0, 0] == 2 ** 60 + 3
    with pytest.raises(OverflowError):
        scores(big, big)


def test_ties_go_to_the_left():
    i, j = first_in_rows(np.array([[1, 3, 3, 2]]), np.array([[True, True, True, False]]), 3)
    assert i.tolist() == [0, 0, 0] and j.tolist() == [1, 2, 0]
    block = Block(np.array([1, 2]), np.array([0, 0]), np.array([[1.0], [70000.0]]))
    assert Block.of(block.packed().to_pylist()[0]).vectors.tolist() == [[1.0], [70000.0]]


def test_query_against_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    name = "op11_hard_negatives"
    got = catalog.QUERIES[name](spark, small)
    expected = con.execute(catalog.ORACLES[name]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected) and expected
