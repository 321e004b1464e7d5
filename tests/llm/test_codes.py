import hashlib
import math
import random

import numpy as np
import pytest

from mercatura.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def brute(rows, parts, entries, rounds):
    kept = [
        (i, [math.floor(1024 * x) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    cuts = [x.tolist() for x in np.array_split(range(size), parts)]
    cut = [[[v[p] for p in c] for c in cuts] for _, v, _ in kept]
    books = [[list(row[p]) for row in cut[:entries]] for p in range(parts)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            chosen = [assign(p, row[p])[1] for row in cut]
            for e in range(len(books[p])):
                mine = [row[p] for row, c in zip(cut, chosen) if c == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[assign(p, row[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], digest) for (i, _, label), f, err in zip(kept, found, errors)),
        key=repr,
    )


def rows_of(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame([(*r, "c", "e") for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, codes.compress(df, parts, entries, rounds).collect()), key=repr)


@pytest.mark.parametrize("parts,size", [(4, 8), (3, 7), (1, 5)])
def test_against_brute_force(spark, parts, size):
    draw = random.Random(size)
    rows = [(i, [draw.choice([-0.25, 0.0, 0.1, 0.3]) + draw.random() / 50 for _ in range(size)], draw.choice([0, 1, None])) for i in range(120)]
    rows += [(200 + i, rows[7][1], 2) for i in range(60)]
    assert rows_of(spark, rows, parts, 16, 3) == brute(rows, parts, 16, 3)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0, -1.0, 0.5], 1), (1, None, 1), (2, [], 1), (3, [1.0, None, 1.0, 1.0], 1),
        (4, [float("nan"), 1.0, 1.0, 1.0], None), (5, [1.0, float("-inf"), 1.0, 1.0], None), (6, [1.0, 2.0], 2),
        (None, [3.0, 2.0, 1.0, 0.0], None), (7, [3.0, 2.0, 1.0, 0.0], None), (7, [0.0, 0.0, 0.0, 0.0], None),
        (8, [1.0, 2.0, -1.0, 0.5], 1), (9, [900.0, -900.0, 1e-30, -1e-30], 4),
    ]
    for entries in (2, 3, 256):
        assert rows_of(spark, rows, 2, entries, 2) == brute(rows, 2, entries, 2)


def test_empty_table_and_large_components(spark):
    assert rows_of(spark, [], 4, 256, 4) == [] and rows_of(spark, [(1, None, 1)], 4, 256, 4) == []
    with pytest.raises(Exception, match="too large"):
        rows_of(spark, [(1, [1e30, 0.0, 0.0, 0.0], 1)], 4, 256, 4)


def test_search_leaves_entries_out_and_still_finds_the_nearest():
    draw = np.random.default_rng(1)
    entries = draw.integers(-3000, 3000, (256, 3))
    entries[40] = entries[12]
    parts = np.concatenate([entries[draw.integers(0, 256, 500)] + draw.integers(-40, 40, (500, 3)), entries])
    number, distance, computed = codes.nearest(parts, entries)
    every = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert number.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()
    assert computed < 0.3 * every.size
