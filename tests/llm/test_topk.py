import math
import random

from pyspark.sql import functions as F

from mercatura.llm import topk


def brute(rows, k):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for q, a in usable:
        if q % 10:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b)
        )
        found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def check(spark, rows, monkeypatch, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(topk, name, value)
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df.repartition(5), F.col("vec_id") % 10 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)


def test_random_with_ties(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, [draw.choice([-0.5, 0.1, 0.25]) for _ in range(3)]) for i in range(150)]
    rows += [(i, [0.3, 0.3, 0.3]) for i in range(200, 260)]
    check(spark, rows, monkeypatch, BINS=7, QUERY_BLOCK=6, TILE=64)


def test_odd_vectors(spark, monkeypatch):
    rows = [
        (0, [1.0, 2.0]), (1, [0.5, float("nan")]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]),
        (5, [-1e6, 3.0]), (6, [1.0]), (7, []), (None, [1.0, 1.0]), (10, [3e4, -2e5]), (8, [2.0, 1.0]), (9, [2.0, 1.0]),
        (20, [1.0, 2.0, 3.0]),
    ]
    check(spark, rows, monkeypatch)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 10 == 0).count() == 0
