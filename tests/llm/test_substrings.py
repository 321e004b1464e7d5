import random
import re

import pytest

from mercatura.llm import substrings


def brute(rows, size):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, float("inf")), order(i))
    found = []
    for i, t in rows:
        w = split(t)
        drop = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < order(i):
                drop |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in drop)
        found.append((i, len(w), len(drop), kept))
    return sorted(found, key=repr)


def made(seed, n=60, size=13):
    draw = random.Random(seed)
    vocabulary = [*"abcde", "é", "ñandú", "\x85x", "x y"]
    passages = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(size - 1, 3 * size))) for _ in range(4)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randint(0, 4)):
            parts.append(draw.choice([*passages, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 9)))]))
        rows.append((draw.randint(0, 40), draw.choice([" ", "\n", "\t\r "]).join(parts)))
    rows += [(None, passages[0]), (None, passages[0]), (3, None), (50, ""), (51, " \n "), (52, rows[0][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, first", [(13, 7), (13, 4), (5, 5), (1, 1)])
def test_against_every_window(spark, monkeypatch, size, first):
    monkeypatch.setattr(substrings.lookup, "LEAST", 4)
    rows = made(size * 10 + first, size=size)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int").repartition(3)
    got = substrings.remove_repeats(docs, size, first)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, size)


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert substrings.remove_repeats(empty).count() == 0
    word = "x" * 400_000
    long = " ".join(["w", word] + [str(k) for k in range(150_000)])
    docs = spark.createDataFrame([(2, long), (1, long[1000:] + " end")], "doc_id int, text string")
    got = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 150_000 and got[2].kept == f"w {word}"
