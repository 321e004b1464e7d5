import random
import re

import pytest

from mercatura.llm import jaccard


def brute(rows, n, share):
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    lead = {i: i for i, _ in rows}

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            if i is not None and j is not None and sets[x] and sets[y]:
                if share[1] * len(sets[x] & sets[y]) >= share[0] * len(sets[x] | sets[y]):
                    a, b = sorted((root(i), root(j)))
                    lead[b] = a
    return sorted([(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)], key=repr)


def made(seed, groups, copies):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghijkl") + draw.choice("mnopqr")
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(draw.randint(1, 60))]
        if draw.random() < 0.5:
            base += passage
        for _ in range(draw.randint(1, copies)):
            one = list(base)
            for _ in range(draw.randint(0, 3)):
                if draw.random() < 0.6:
                    one[draw.randrange(len(one))] = draw.choice([word(), "É", "x"])
                else:
                    one.insert(draw.randrange(len(one)), word())
            texts.append(draw.choice([" ", "\n "]).join(one).upper() if draw.random() < 0.2 else " ".join(one))
    ids = draw.sample(range(10 * len(texts)), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("share, rounds", [((85, 100), 2), ((60, 100), 0), ((80, 100), 1)])
def test_against_all_pairs(spark, monkeypatch, share, rounds):
    monkeypatch.setattr(jaccard.lookup, "LEAST", 4)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", rounds)
    rows = made(share[0] + rounds, 25, 12)
    rows += [(None, rows[0][1]), (None, None), (100_000, None), (100_001, ""), (100_002, " \n"),
             (100_003, "one two"), (100_004, "ONE\ttwo"), (100_005, "two one"), (rows[0][0], rows[3][1])]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, grams int").repartition(3)
    got = jaccard.jaccard_components(docs, 4, share).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4, share)


def test_empty_and_hot_group(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    base = [f"w{k}" for k in range(80)]
    rows = [(5, "lone text of its own here")]
    rows += [(k, " ".join([*base[: k % 80], f"x{k}", *base[k % 80 + 1 :]])) for k in range(10, 400)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(r[2] and r[0], r[2]) for r in brute(rows, 4, (85, 100))}


def test_buckets_grow_with_the_text(spark, monkeypatch):
    asked = []
    prefixes = jaccard.rare_prefixes
    monkeypatch.setattr(jaccard, "rare_prefixes", lambda sets, share, bits: asked.append(bits) or prefixes(sets, share, bits))
    monkeypatch.setattr(jaccard.lookup, "BUCKET_BYTES", 16)
    rows = made(3, 20, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_components(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 4, (85, 100))
    n_bytes = sum(len(text.encode()) for _, text in rows)
    assert n_bytes > 64 * 16 and all(2**bits * 16 >= n_bytes for bits in asked) and len(asked) == 1


def test_link_of_one_row_is_a_link_of_its_id(spark):
    text = "a text that two documents hold word for word"
    rows = [(3, text), (5, text), (5, "quite another text that no other document has"), (7, None), (7, text), (8, "")]
    rows += [(9, "alone here with its own few words"), (9, "alone there with some more and other words"), (None, text)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 4, (85, 100))
