import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercatura.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label long, score int, rank int, turn string"


def brute(rows, k, share):
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in kept}:
        if i % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other == label) for j, w, other in kept if j != i and len(w) == len(v)]
        for p, j, _ in sorted(s for s in scored if s[2])[:k]:
            inside = sorted(s for s in scored if not s[2] and share[0] * -p <= share[1] * -s[0] <= share[1] * -p)
            found += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(inside[:k], 1)]
    return sorted(found)


def check(spark, rows, monkeypatch, k=3, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(negatives, name, value)
    df = spark.createDataFrame([(*r, 0, 0, "t") for r in rows], SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), k=k)
    want = brute(rows, k, (80, 100))
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_random_with_ties(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, [draw.choice([-0.5, 0.1, 0.25]) for _ in range(4)], draw.randint(0, 2)) for i in range(200)]
    rows += [(300 + i, [0.3, 0.3, 0.3, 0.3], i % 2) for i in range(40)]
    assert len(check(spark, rows, monkeypatch, BUCKET=16, TILE=5, CHUNK=40)) > 100


@pytest.mark.parametrize("dense", [0.0, 2.0])
def test_lengths_and_directions(spark, monkeypatch, dense):
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((6, 12))
    rows = []
    for i in range(400):
        v = (centres[draw.integers(6)] + 0.15 * draw.standard_normal(12)) * draw.choice([0.1, 1, 5])
        rows.append((i, v.tolist(), int(draw.integers(3))))
    assert check(spark, rows, monkeypatch, k=5, BUCKET=32, DENSE=dense, PASS_BYTES=2000)


def test_pruning_leaves_pairs_out_but_none_that_reach():
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((20, 16))
    vectors = np.floor(256 * (centres[draw.integers(0, 20, 3000)] + 0.1 * draw.standard_normal((3000, 16))))
    ids = np.arange(3000)
    anchors = negatives.Anchors(np.arange(50), ids[:50], np.zeros(50, int), vectors[:50])
    exact = anchors.vectors @ vectors.T
    worth = np.sort(exact, axis=1)[:, -30]
    kept = 0
    for bucket in negatives.buckets(ids, np.zeros(3000, int), vectors):
        mask, some = negatives.candidates(bucket, anchors, np.arange(50), worth)
        reached = np.zeros((50, len(bucket.ids)), dtype=bool)
        reached[some] = mask
        assert not (~reached & (exact[:, bucket.ids] >= worth[:, None])).any()
        kept += mask.sum()
    assert kept < 0.3 * exact.size


def test_odd_rows(spark, monkeypatch):
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, float("nan")], 1), (2, None, 2), (3, [None, 1.0], 1), (4, [float("inf"), 0.0], 1),
        (5, [1.0, 2.1], 1), (6, [1.0], 1), (7, [], 1), (None, [1.0, 1.0], 2), (8, [1.0, 2.0], 2), (9, [1.0, 1.8], 2),
        (10, [0.0, 0.0], 1), (10, [0.5, 0.5], 2), (11, [-1.0, 0.0], 1), (12, [-2.0, 0.1], 2), (20, [-1.0, -1.0], None),
        (30, [1.0, 2.0], 1), (30, [1.0, 2.0], 1), (40, [3.0, -1.0, 2.0], 5), (0, [1.0, 2.0], 2),
    ]
    assert check(spark, rows, monkeypatch)
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.lit(True), F.col("label")).count() == 0
    lone = spark.createDataFrame([(0, [1.0], 1, 0, 0, "t")], SCHEMA)
    assert negatives.hard_negatives(lone, F.lit(True), F.col("label")).count() == 0
