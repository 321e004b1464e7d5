import random
import re

import pytest

from mercatura.llm import decontaminate


def split(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size, slop):
    windows = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - size + 1)):
            if w:
                windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    counts = {}
    for _, text in docs:
        for w in split(text):
            counts[w] = counts.get(w, 0) + 1
    found = []
    for i, text in docs:
        w = split(text)
        hit, listed = set(), set()
        for window, who in windows.items():
            if any(t not in counts for t in window):
                continue
            first = min(range(len(window)), key=lambda k: (counts[window[k]], k))
            for s in range(len(w)):
                near = lambda k: range(s + k - slop, s + k + slop + 1)
                at = lambda p: w[p] if 0 <= p < len(w) else None
                if at(s + first) == window[first] and all(
                    k == first or any(at(p) == t for p in near(k)) for k, t in enumerate(window)
                ):
                    hit |= set(range(s, s + len(window)))
                    listed |= who
        found.append((i, len(w), len(hit), sorted(listed - {"None"})))
    return sorted(found, key=repr)


@pytest.mark.parametrize("size, slop", [(4, 0), (2, 0), (4, 1)])
def test_against_every_place(spark, size, slop):
    draw = random.Random(size + slop)
    word = lambda: draw.choice(["a", "B", "c", "dé", "É", "7", "日本", "x-y", "a.b"])
    items = [(k % 9, " ".join(word() for _ in range(draw.randint(0, 9)))) for k in range(12)]
    items += [(50, None), (51, "..."), (52, "Solo"), (53, "a"), (None, "dé dé dé dé dé")]
    docs = [(k % 40, draw.choice([" ", ", ", "\n"]).join(word() for _ in range(draw.randint(0, 25)))) for k in range(60)]
    docs += [(None, items[1][1] + " tail"), (None, None), (90, ""), (91, "-- solo! "), (92, ".a.")]
    docs += [docs[0], docs[0]]
    frame = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, pos int").repartition(3)
    bench = spark.createDataFrame([(*r, "") for r in items], "item_id long, text string, window string")
    got = decontaminate.hits(frame, bench, size, slop).select("doc_id", "n_words", "n_hit", "items")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, size, slop)


def test_slop_at_the_head(spark):
    bench = spark.createDataFrame([(1, "x y z")], "item_id int, text string")
    texts = ["x z y", "p x z y", "x y x y", "z x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.hits(docs, bench, 3, 2).collect()}
    assert got == {0: (2, ["1"]), 1: (3, ["1"]), 2: (0, []), 3: (0, [])}


def test_empty_and_long(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id int, text string")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.hits(empty, bench, 3).count() == 0
    docs = spark.createDataFrame([(1, "pad " * 200_000 + "one Two three")], "doc_id long, text string")
    got = decontaminate.hits(docs, bench, 3).first()
    assert (got.n_words, got.n_hit, got.items) == (200_003, 3, ["1"])
    none = decontaminate.hits(docs, bench.limit(0), 3).first()
    assert (none.n_words, none.n_hit, none["items"]) == (200_003, 0, [])


def test_texts_are_cut_once_and_only_ascii_capitals_are_folded(spark, rows):
    texts = [(1, "-A Kİb; Z"), (2, "B..c"), (3, ""), (4, " "), (5, None), (6, "ÄB x")]
    made = decontaminate.placed_terms(spark.createDataFrame(texts, "doc int, text string"), ["doc"], "text")
    assert rows(made) == [
        (1, 0, "a"), (1, 1, "Kİb"), (1, 2, "z"), (2, 0, "b"), (2, 1, "c"), (6, 0, "Äb"), (6, 1, "x"),
    ]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
