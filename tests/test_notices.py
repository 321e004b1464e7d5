import hashlib
import itertools
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from mercatura.functions import minhash, sets, text as tx
from mercatura.functions.minhash import PRIME, coefficients
from mercatura.operators import evaluate, lsh, nights, register, resolve as rs, shingles as sh
from mercatura.plans import notices as queries


def one(spark, expression, **values):
    columns = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], columns).select(expression).first()[0]


@pytest.mark.parametrize(
    ("source", "body", "expected"),
    [
        ("P001", "PREAMBLE NOTICE DETAILS FOLLOW Road work Disclaimer: none", "notice details follow road work"),
        ("P001", "Disclaimer: before NOTICE DETAILS FOLLOW work", "notice details follow work"),
        ("P004", "PREAMBLE " + "=" * 79 + " Bridge", "bridge"),
        ("P009", "PREAMBLE NOTICE DETAILS FOLLOW Road", "preamble notice details follow road"),
        ("P009", "Work NPAS-2024-0001234 and SPC/2024-25/004512 end", "work and end"),
        ("P009", "by reference only", "by only"),
        ("P009", "due 12-03-2024 or 2024.3.12 or 12 Mar 2024 noon", "due or or noon"),
        ("P009", "cost Rs. 4,50,000.00 lakh or INR 4.500 Cr here", "cost or here"),
        ("P009", "éref123 stays, ref123 goes", "ref123 stays goes"),
        ("P009", "Número único", "n mero nico"),
        ("P009", None, ""),
    ],
)
def test_clean_text(spark, source, body, expected):
    got = one(spark, tx.clean_text(F.col("body"), F.col("source")), source=source, body=body)
    assert got == expected


def test_month_names_can_be_left_in(spark):
    cleaned = tx.clean_text(
        F.col("body"), F.col("source"), patterns=tx.NOISE_PATTERNS_WITHOUT_MONTH_NAMES
    )
    assert one(spark, cleaned, source="P9", body="12 Mar 2024 noon") == "12 mar 2024 noon"


def test_clean_text_simple(spark):
    got = one(
        spark,
        tx.clean_text_simple(F.col("body")),
        body="State Procurement Cell: Niño's  road, 12 km\n(new_one)",
    )
    assert got == "NIÑOS ROAD KM NEW_ONE"


def python_bigrams(clean):
    words = clean.split()
    return {" ".join(pair) for pair in zip(words, words[1:])} if len(words) > 1 else set(words)


@pytest.mark.parametrize("clean", ["", "one", "a b", "a b a b a", "x1 y2 z3 x1 y2"])
def test_word_bigrams(spark, clean):
    got = one(spark, tx.word_bigrams(F.col("c")), c=clean)
    assert len(got) == len(set(got)) and set(got) == python_bigrams(clean)


@pytest.mark.parametrize("body", ["", "Ab", "  Añb\n\ncd  Ef ", "aaaaaaaa", "x\U0001f600y\U0001f600z w"])
def test_char_kgrams(spark, body):
    flat = re.sub(r"\s+", " ", body.lower()).strip()
    grams = {flat[i : i + 5] for i in range(len(flat) - 4)} if len(flat) >= 5 else {flat} - {""}
    assert set(one(spark, tx.raw_char_kgrams(F.col("b")), b=body)) == grams
    threes = {flat[i : i + 3] for i in range(len(flat) - 2)}
    assert set(one(spark, tx.char_kgrams(F.lit(flat), 3, keep_short=False), b=body)) == threes


def test_jaccard_of_empty_sets_is_zero(spark):
    data = spark.createDataFrame(
        [(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>"
    )
    scores = [r.j for r in data.select(tx.set_jaccard(F.col("a"), F.col("b")).alias("j")).collect()]
    assert scores == [1 / 3, 0.0, 0.0]


def test_stop_shingles_need_strictly_more_than_the_share(spark, rows):
    notices = spark.createDataFrame([(i, "common pair" if i < 2 else "rare") for i in range(10)], "notice_id long, clean string")
    nine = notices.filter("notice_id <> 9")
    frequency = sh.document_frequency(sh.shingle_rows(sh.distinct_documents(notices)))
    assert rows(sh.stop_shingles(frequency, notices, 0.2)) == [("rare", 8)]
    frequency = sh.document_frequency(sh.shingle_rows(sh.distinct_documents(nine)))
    assert rows(sh.stop_shingles(frequency, nine, 0.2)) == [("common pair", 2), ("rare", 7)]


def corpus(seed=5, families=12, size=5, words=24):
    """Families of near copies, crowds with a shared preamble, exact copies, and an empty text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    preamble = [f"legal{i}" for i in range(10)]
    texts = []
    for family in range(families):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join((preamble if family % 2 else []) + copy))
        texts.append(texts[-1])
    return list(enumerate(texts + ["", ""], start=100))


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def scene(spark):
    """A corpus with its bucket table, unpruned so that the preamble makes crowded buckets."""
    notices = corpus()
    cleaned = spark.createDataFrame(notices, "notice_id long, clean string")
    documents = sh.distinct_documents(cleaned).cache()
    rows = sh.shingle_rows(documents)
    bands = lsh.band_rows(lsh.signature_parts(rows)).cache()
    texts = {r.doc: python_bigrams(r.clean) for r in documents.collect()}
    buckets = {}
    for r in bands.collect():
        buckets.setdefault((r.band_id, r.bucket_hash), set()).add(r.doc)
    pairs = {p for members in buckets.values() for p in itertools.combinations(sorted(members), 2)}

    def score(a, b):
        return len(texts[a] & texts[b]) / len(texts[a] | texts[b])

    verified = {(a, b): score(a, b) for a, b in pairs if score(a, b) >= 0.55}
    return {
        "notices": notices, "cleaned": cleaned, "documents": documents, "bands": bands,
        "frequency": sh.document_frequency(rows), "pairs": pairs, "verified": verified,
        "texts": texts, "largest": max(map(len, buckets.values())),
    }


def test_signature_is_the_minimum_of_each_function(spark, scene):
    import hashlib

    values = lsh.signature_values(
        lsh.signature_parts(sh.shingle_rows(scene["documents"]), lsh.OLDER), lsh.OLDER
    )
    got = {(r.doc, r.position): r.min_hash for r in values.collect()}
    assert {p for _, p in got} == set(range(126))
    for doc in list(scene["texts"])[:3]:
        hashes = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for s in scene["texts"][doc]]
        for position, (a, b) in enumerate(coefficients(126)):
            assert got[doc, position] == min((h * a + b) % PRIME for h in hashes)


def test_every_document_has_every_band_and_empty_text_has_none(scene):
    counted = scene["bands"].groupBy("doc").count().collect()
    assert {r["count"] for r in counted} == {32}
    assert {r.doc for r in counted} == set(scene["texts"])
    assert all(text for _, text in scene["notices"] if _ in scene["texts"])


def may_reach(scene, threshold=0.55):
    """Pairs that share a bucket and one of their rarest shingles, of sizes that allow the threshold."""
    df = {r.shingle: r.df for r in scene["frequency"].collect()}
    rare = {}
    for doc, text in scene["texts"].items():
        ordered = sorted(set(text), key=lambda x: (df[x], x))
        rare[doc] = (set(ordered[: len(ordered) - math.ceil(len(ordered) * threshold - 1e-6) + 1]), len(ordered))
    return {
        (a, b)
        for a, b in scene["pairs"]
        if rare[a][0] & rare[b][0]
        and min(rare[a][1], rare[b][1]) >= max(rare[a][1], rare[b][1]) * threshold - 1e-6
    }


def test_crowds_give_the_same_candidates_whole_divided_or_sliced(scene, rows, monkeypatch):
    for crowd, spread in ((2, 3), (10_000, 2)):
        monkeypatch.setattr(lsh, "CROWD", crowd)
        monkeypatch.setattr(lsh, "SPREAD", spread)
        found = rows(lsh.candidate_pairs(scene["bands"], scene["documents"], scene["frequency"]))
        assert len(found) == len(set(found)) and set(found) == may_reach(scene)


def test_crowd_of_near_copies_meets_once_and_one_of_others_is_divided(spark):
    n = lsh.CROWD + 6
    crowd = spark.createDataFrame(
        [(d, band, "x", n) for band in (0, 1) for d in range(n)], "doc long, band_id int, bucket_hash string, n long"
    )
    # alone: no two share a rare shingle; copies: all share their forty rarest
    alone = spark.createDataFrame([(d, 50, [d]) for d in range(n)], "doc long, n_shingles int, prefix array<long>")
    copies = spark.createDataFrame(
        [(d, 50, list(range(1, 41))) for d in range(n)], "doc long, n_shingles int, prefix array<long>"
    )
    assert lsh.divided_crowds(crowd, alone).count() == 2
    divided = lsh.divided_crowds(crowd, copies)
    assert divided.count() == 0
    assert lsh.meeting_rows(crowd, divided, copies).count() == 2 * n


def test_pair_scores_read_a_text_once_for_its_tile_and_keep_every_text_of_an_id(spark, rows, monkeypatch):
    texts = [(d, f"tender for road works lot {d % 7} in district {d % 3}") for d in range(12)] + [(3, "tender for road"), (5, "x")]
    documents = spark.createDataFrame(texts, "doc long, clean string")
    pairs = spark.createDataFrame(
        [(a, b) for a in range(12) for b in range(a + 1, 14)] + [(None, 3)], "doc_a long, doc_b long"
    )
    score = sets.pair_jaccard(F.col("text_a"), F.col("text_b")).alias("jaccard")
    by_pair = rs.attach_text(pairs, documents, "doc_a", "doc_b").select("doc_a", "doc_b", score)
    for tile in (2, 256):
        monkeypatch.setattr(rs, "TILE", tile)
        assert rows(rs.score_pairs(pairs, documents)) == rows(by_pair)

    made = spark.createDataFrame(
        [(1, d, f"road works {d}", None, None) for d in range(20)] + [(1, None, None, 0, d) for d in range(20)],
        "key long, doc long, text string, doc_a long, doc_b long",
    ).coalesce(1)
    schema = pairs.schema.add("jaccard", "double")
    assert sets.keyed_jaccard(made, schema).count() == 20


def test_candidates_share_a_bucket_and_may_reach_the_threshold(scene, rows):
    found = lsh.candidate_pairs(scene["bands"], scene["documents"], scene["frequency"])
    candidates = set(rows(found))
    assert candidates == may_reach(scene) and len(candidates) < len(scene["pairs"])
    verified = rs.verify(found, scene["documents"]).collect()
    assert {(r.doc_a, r.doc_b): r.jaccard for r in verified} == pytest.approx(scene["verified"])


def test_all_pairs_of_a_bucket_are_listed_whatever_their_similarity(scene, rows, monkeypatch):
    for spread in (3, 1024):
        monkeypatch.setattr(lsh, "SPREAD", spread)
        found = rows(lsh.bucket_pairs(scene["bands"]))
        assert len(found) == len(set(found)) and set(found) == scene["pairs"] > may_reach(scene)


def test_candidate_query_leaves_out_no_pair_of_a_bucket(spark, rows, tmp_path):
    texts = [(doc, text, "en", "src9", len(text)) for doc, text in corpus()]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    buckets = {}
    for r in queries.bands(spark, str(tmp_path)).collect():
        buckets.setdefault((r.band_id, r.bucket_hash), set()).add(r.doc)
    shared = {p for members in buckets.values() for p in itertools.combinations(sorted(members), 2)}
    found = rows(queries.lsh_candidates(spark, str(tmp_path)))
    assert found == sorted(shared, key=repr)
    filtered = lsh.candidate_pairs(*(part(spark, str(tmp_path)) for part in (queries.bands, queries.documents, queries.frequency)))
    assert set(rows(filtered)) < shared
    verified = rows(queries.verified_pairs(spark, str(tmp_path)), "doc_a", "doc_b")
    reached = rs.verify(spark.createDataFrame(sorted(shared), "doc_a long, doc_b long"), queries.documents(spark, str(tmp_path)))
    assert verified == rows(reached, "doc_a", "doc_b")


def test_components_equal_those_of_all_verified_pairs(scene):
    got = rs.match_components(scene["bands"], scene["documents"], scene["frequency"]).collect()
    expected = components(scene["texts"], scene["verified"])
    assert len(got) == len({r.doc for r in got})
    merged = {r.doc: r.component for r in got}
    assert {d: merged.get(d, d) for d in scene["texts"]} == expected


def test_one_definition_in_buckets_of_any_size(spark, rows):
    """A bucket of 140 members: the same pairs as by brute force, and the same components."""
    rng = random.Random(8)
    base = [f"term{i}" for i in range(30)]
    texts = {}
    for i in range(140):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(30)] = f"own{rng.randrange(60)}"
        texts[i] = " ".join(words)
    cleaned = spark.createDataFrame(list(texts.items()), "notice_id long, clean string")
    documents = sh.distinct_documents(cleaned).cache()
    shingles = sh.shingle_rows(documents)
    kept = {r.doc for r in documents.collect()}
    bands = documents.selectExpr("doc", "0 AS band_id", "'one' AS bucket_hash").cache()
    grams = {d: python_bigrams(texts[d]) for d in kept}
    scene = {
        "frequency": sh.document_frequency(shingles).cache(), "texts": grams,
        "pairs": {(a, b) for a in kept for b in kept if a < b},
    }
    found = lsh.candidate_pairs(bands, documents, scene["frequency"])
    assert set(rows(found)) == may_reach(scene)
    alike = {(a, b) for a, b in scene["pairs"] if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.55}
    got = {r.doc: r.component for r in rs.match_components(bands, documents, scene["frequency"]).collect()}
    assert {d: got.get(d, d) for d in kept} == components(kept, alike)


def test_resolve_puts_every_notice_in_one_cluster(spark, scene):
    members = rs.resolve(scene["cleaned"]).collect()
    assert sorted(r.notice_id for r in members) == [n for n, _ in scene["notices"]]
    by_text = {}
    for notice, text in scene["notices"]:
        by_text.setdefault(text, []).append(notice)
    owner = {r.notice_id: r.canonical_notice_id for r in members}
    for text, notices in by_text.items():
        if text:
            assert len({owner[n] for n in notices}) == 1
        else:
            assert [owner[n] for n in notices] == notices
    assert all(r.opportunity_id == f"OPP_{r.canonical_notice_id}" for r in members)
    assert all(owner[r.canonical_notice_id] == r.canonical_notice_id for r in members)


def test_crowd_of_near_copies_is_settled_without_pairing_it_up(spark):
    """A hot bucket whose members all match its smallest member leaves no bucket mixed."""
    base = " ".join(f"term{i}" for i in range(60))
    cleaned = spark.createDataFrame(
        [(i, f"{base} tail{i}") for i in range(300)], "notice_id long, clean string"
    )
    documents = sh.distinct_documents(cleaned)
    bands = lsh.band_rows(lsh.signature_parts(sh.shingle_rows(documents))).cache()
    stars = rs.bucket_stars(bands)
    assert stars.count() <= bands.count()
    first = rs.verify(stars, documents)
    labels = rs.connected_components(first.select("doc_a", "doc_b")).toDF("doc", "label")
    assert labels.select("label").distinct().count() == 1
    assert rs.mixed_buckets(bands, labels).isEmpty()


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 30)] + [(50, i) for i in range(51, 60)] + [(29, 60), (59, 60)],
        [(3, 2), (2, 1), (1, 3), (9, 8), (8, 9)],
    ],
)
def test_connected_components(spark, edges):
    found = rs.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for e in edges for n in e}
    assert {r.node: r.component for r in found} == components(nodes, edges)
    assert len(found) == len(nodes)


def test_components_of_no_edges(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert rs.connected_components(empty).collect() == []


def test_aliases_follow_merges_and_compress_chains(spark, rows):
    night1 = spark.createDataFrame([("a", "OPP_a"), ("b", "OPP_b"), ("c", "OPP_c")], "notice_id string, opportunity_id string")
    night2 = spark.createDataFrame([("a", "OPP_a"), ("b", "OPP_b"), ("c", "OPP_b")], night1.schema)
    night3 = spark.createDataFrame([("a", "OPP_a"), ("b", "OPP_a"), ("c", "OPP_a"), ("d", "OPP_d")], night1.schema)
    second = rs.new_aliases(night1, night2)
    assert rows(second) == [("OPP_c", "OPP_b")]
    table = rs.merge_aliases(second, rs.new_aliases(night2, night3), night3)
    assert rows(table) == [("OPP_b", "OPP_a"), ("OPP_c", "OPP_a")]
    resolved = rs.resolve_bookmarks(night1, table)
    assert rows(resolved, "notice_id", "opportunity_id") == [("a", "OPP_a"), ("b", "OPP_a"), ("c", "OPP_a")]


def test_s_curve_has_the_published_values(spark):
    """Seven similarities under three layouts; the recorded table has four decimals."""
    expected = {
        0.10: (0.0000, 0.0032, 0.4744), 0.30: (0.0010, 0.2291, 0.9976), 0.50: (0.0607, 0.8732, 1.0),
        0.60: (0.2374, 0.9882, 1.0), 0.70: (0.6133, 0.9998, 1.0), 0.80: (0.9470, 1.0, 1.0),
        0.90: (0.9999, 1.0, 1.0),
    }
    data = spark.createDataFrame([(s,) for s in expected], "s double")
    curves = [evaluate.candidate_probability(F.col("s"), b, r) for b, r in evaluate.CURVES]
    for row in data.select("s", *[F.round(c, 4) for c in curves]).collect():
        assert tuple(row)[1:] == pytest.approx(expected[row.s], abs=1e-9)
    assert evaluate.curve_threshold(14, 9) == pytest.approx(0.746, abs=5e-4)


def test_threshold_sweep_prices_errors(spark, rows):
    scored = spark.createDataFrame(
        [("same", 0.9), ("same", 0.5), ("different", 0.45), ("different", 0.1)], "label string, jaccard double"
    )
    sweep = evaluate.threshold_sweep(scored)
    assert rows(sweep, "tau", "tp", "fp", "fn", "cost", "cheapest") == [
        (0.4, 2, 1, 0, 50000, False), (0.5, 2, 0, 0, 0, True), (0.55, 1, 0, 1, 100, False),
    ]


def test_histogram_and_base_rate(spark, rows):
    members = spark.createDataFrame(
        [(i, f"O{min(i, 3)}") for i in range(6)], "notice_id long, opportunity_id string"
    )
    assert rows(rs.size_histogram(members)) == [(1, 3, 3, 0.0), (3, 1, 3, 3.0)]
    labelled = spark.createDataFrame([("same",), ("different",)], "label string")
    rate = evaluate.base_rate(members, labelled).first()
    assert (rate.possible_pairs, rate.duplicate_pairs, rate.corpus_rate, rate.label_rate) == (15.0, 3.0, 0.2, 0.5)


def test_lookup_finds_the_mates_of_a_batch(scene, rows):
    docs = sorted(scene["texts"])
    batch = set(docs[::5])
    incoming = scene["documents"].select("doc").filter(F.col("doc").isin(*batch))
    found = rows(lsh.lookup(scene["bands"], incoming, scene["documents"], scene["frequency"]))
    crossing = {p for p in may_reach(scene) if len(batch & set(p)) == 1}
    assert {tuple(sorted(r[:2])) for r in found} == crossing
    assert all(r[0] in batch and 1 <= r[2] <= 32 for r in found)


def test_second_run_reaches_the_clusters_of_one_full_run(scene):
    docs = sorted(scene["texts"])
    incoming = scene["documents"].select("doc").filter(F.col("doc").isin(*docs[::3]))
    stored = scene["bands"].join(incoming, "doc", "left_anti")
    common = scene["documents"], scene["frequency"]
    first = rs.match_components(stored, *common)
    second = rs.extend_components(first, scene["bands"], incoming, *common).collect()
    merged = {r.doc: r.component for r in second}
    assert len(merged) == len(second)
    assert {d: merged.get(d, d) for d in docs} == components(docs, scene["verified"])


def test_cap_boundary(spark, rows):
    bands = spark.createDataFrame(
        [(i, 0, "full") for i in range(100)] + [(i, 1, "over") for i in range(101)],
        "doc long, band_id int, bucket_hash string",
    )
    pairs = spark.createDataFrame([(0, 1), (0, 100), (0, 999)], "doc_a long, doc_b long")
    counted = lsh.with_kept_bands(pairs, bands, "doc_a", "doc_b", (100, 101))
    assert rows(counted) == [(0, 1, 2, 1, 2), (0, 100, 1, 0, 1), (0, 999, 0, 0, 0)]
    report = lsh.skew_summary(bands, 100).first()
    assert (report.hot_buckets, report.largest_kept, report.implied_pairs_kept) == (1, 100, 4950.0)


def test_alias_of_an_identifier_that_is_live_again_is_dropped(spark, rows):
    night1 = spark.createDataFrame([("a", "OPP_a"), ("b", "OPP_b")], "notice_id string, opportunity_id string")
    night2 = spark.createDataFrame([("a", "OPP_a"), ("b", "OPP_a")], night1.schema)
    first = rs.new_aliases(night1, night2)
    assert rows(first) == [("OPP_b", "OPP_a")]
    again = rs.merge_aliases(first, rs.new_aliases(night2, night1), night1)
    assert rows(again) == [] and rows(rs.resolve_bookmarks(night1, again), "opportunity_id") == [("OPP_a",), ("OPP_b",)]


def test_stored_tables_over_three_nights(spark, rows):
    """A merge, a late notice and a split: who is known since when, and where old identifiers lead."""
    schema = "notice_id string, canonical_notice_id string, opportunity_id string"
    night = lambda *owners: spark.createDataFrame([(n, o, f"OPP_{o}") for n, o in owners], schema)
    runs = [
        ("d1", night(("b", "b"), ("c", "c"))),
        ("d2", night(("b", "b"), ("c", "b"), ("a", "a"))),
        ("d3", night(("b", "a"), ("c", "c"), ("a", "a"))),
    ]
    seen = joined = aliases = dated = None
    for k, (at, members) in enumerate(runs):
        if k:
            new = rs.new_aliases(runs[k - 1][1], members)
            aliases = rs.merge_aliases(new.limit(0) if aliases is None else aliases, new, members)
            dated = rs.dated_aliases(aliases, at, dated)
        seen = rs.opportunities(members, at, seen)
        joined = rs.memberships(members, at, joined)
    assert rows(seen) == [("OPP_a", "a", "d2"), ("OPP_c", "c", "d3")]
    assert rows(joined) == [("a", "OPP_a", "d2"), ("b", "OPP_a", "d3"), ("c", "OPP_c", "d3")]
    assert rows(dated) == [("OPP_b", "OPP_a", "d3")]


def test_register_over_five_nights(spark, rows, tmp_path):
    """A merge, a missing night, a split and a merge again; a quiet night writes nothing."""
    schema = "notice_id string, canonical_notice_id string, opportunity_id string"
    night = lambda *owners: spark.createDataFrame([(n, o, f"OPP_{o}") for n, o in owners], schema)
    runs = [
        night(("a", "a"), ("b", "b"), ("c", "c"), ("e", "e")),
        night(("a", "a"), ("b", "b"), ("c", "b")),
        night(("a", "a"), ("b", "a"), ("c", "a"), ("e", "e")),
        night(("a", "a"), ("b", "a"), ("c", "c"), ("e", "e")),
        night(("a", "a"), ("b", "a"), ("c", "a"), ("e", "e")),
    ]
    aliases = []
    for k, run in enumerate(runs, 1):
        register.record_run(run, f"d{k}", str(tmp_path), 4)
        aliases.append(rows(register.read(spark, str(tmp_path), register.ALIASES)))
    assert aliases == [
        [],
        [("OPP_c", "OPP_b", "d2")],
        [("OPP_b", "OPP_a", "d3"), ("OPP_c", "OPP_a", "d2")],
        [("OPP_b", "OPP_a", "d3"), ("OPP_c", "OPP_c", "d4")],
        [("OPP_b", "OPP_a", "d3"), ("OPP_c", "OPP_a", "d5")],
    ]
    assert rows(register.read(spark, str(tmp_path), register.OPPORTUNITIES)) == [
        ("OPP_a", "a", "d1"), ("OPP_b", "b", "d1"), ("OPP_c", "c", "d1"), ("OPP_e", "e", "d1")
    ]
    assert rows(register.read(spark, str(tmp_path), register.MEMBERS)) == [
        ("a", "OPP_a", "d1"), ("b", "OPP_a", "d3"), ("c", "OPP_a", "d5"), ("e", "OPP_e", "d1")
    ]
    assert register.record_run(runs[-1], "d6", str(tmp_path), 4) == {
        "old_opportunity_id": [], "opportunity_id": [], "notice_id": []
    }


def test_chains_over_many_nights(spark, rows):
    schema = "night int, old_opportunity_id string, active_opportunity_id string"
    steps = [(k, f"n{k}", f"n{k - 1}") for k in range(1, 12)]
    steps += [(1, "b", "a"), (2, "a", "b"), (2, "b", "b"), (3, "c", "a"), (4, "x", "n3"), (5, "x", "n0")]
    want = [(f"n{k}", "n0", k) for k in range(1, 12)] + [("a", "b", 1), ("c", "b", 2), ("x", "n0", 1)]
    assert rows(rs.resolve_chains(spark.createDataFrame(steps, schema))) == sorted(want, key=repr)
    assert rows(rs.resolve_chains(spark.createDataFrame([], schema))) == []
    for n in (2, 3, 5):
        circle = [(1, f"o{k}", f"o{(k + 1) % n}") for k in range(n)] + [(1, "in", "o0")]
        with pytest.raises(ValueError, match="lead back"):
            rs.resolve_chains(spark.createDataFrame(circle, schema))


def test_log_of_aliases_notes_identifiers_that_are_live_again(spark, rows):
    schema = "notice_id string, opportunity_id string"
    night = lambda *owners: spark.createDataFrame([(n, f"OPP_{o}") for n, o in owners], schema)
    runs = [night(("a", "a"), ("b", "b")), night(("a", "a"), ("b", "a")), night(("a", "a"), ("b", "b"))]
    log = rs.logged_aliases(None, rs.new_aliases(runs[0], runs[1]), runs[1], 2)
    assert rows(rs.resolve_chains(log)) == [("OPP_b", "OPP_a", 1)]
    log = rs.logged_aliases(log, rs.new_aliases(runs[1], runs[2]), runs[2], 3)
    assert rows(rs.resolve_chains(log)) == []


def test_nights_equal_a_full_run(spark, rows):
    """Late copies with smaller and larger ids, a stop list that moves both ways, a component that splits."""
    draw = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choices(words, k=14)) for _ in range(40)]
    near = [t.replace(t.split()[k % 14], f"z{k}", 1) for k, t in enumerate(texts[:20])]
    common = "alpha beta gamma delta"
    first = [(f"m{k:03}", t) for k, t in enumerate(texts + near)]
    # two shingles become frequent on the second night, one is no longer frequent
    first += [(f"p{k}", f"{common} {' '.join(draw.choices(words, k=5))}") for k in range(5)]
    first += [(f"q{k}", f"epsilon zeta {' '.join(draw.choices(words, k=9))}") for k in range(9)]
    first += [("s1", f"{common} one"), ("s2", f"{common} two")]
    second = [(f"a{k}", t) for k, t in enumerate(texts[3:8])] + [(f"z{k}", t) for k, t in enumerate(near[4:9])]
    second += [(f"n{k}", near[k].replace(near[k].split()[5], "y", 1)) for k in range(10, 20)]
    second += [(f"r{k}", f"{common} {' '.join(draw.choices(words, k=7))}") for k in range(14)] + [("e1", ""), ("e2", "")]
    table = lambda found: spark.createDataFrame([(i, "p", t) for i, t in found], "notice_id string, portal_id string, clean string")
    whole = table(first + second)
    one = nights.first_night(table(first))
    two = nights.next_night(one, table(second))
    full = nights.first_night(whole)
    for name in ("documents", "frequency", "stop", "bands"):
        assert rows(getattr(two, name)) == rows(getattr(full, name)), name
    assert rows(nights.members_of(two, whole)) == rows(rs.resolve(whole))
    moved = {r.shingle for r in one.stop.collect()} ^ {r.shingle for r in two.stop.collect()}
    assert moved and two.signed.count() < two.documents.count()
    grams = lambda t: {" ".join(p) for p in zip(t.split(), t.split()[1:])}
    known = {t for _, t in first}
    held = {r.doc for r in two.documents.collect() if r.clean not in known or grams(r.clean) & moved}
    assert {r.doc for r in two.signed.collect()} == held
    before = {r.notice_id: r.opportunity_id for r in nights.members_of(one, table(first)).collect()}
    after = {r.notice_id: r.opportunity_id for r in nights.members_of(two, whole).collect()}
    apart = [(a, b) for a in before for b in before if before[a] == before[b] and after[a] != after[b]]
    assert apart, "a link by a shingle that became frequent is gone"


def test_index_gives_the_rows_of_the_lookup_and_reads_few_files(spark, rows, monkeypatch):
    draw = random.Random(21)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(draw.choices(words, k=16)) for _ in range(120)]
    texts += [t.replace(t.split()[3], "zz", 1) for t in texts[:60]] + ["a crowd of " + str(k // 2) for k in range(30)]
    table = spark.createDataFrame(list(enumerate(texts)), "notice_id long, clean string")
    docs = lsh.stage(sh.distinct_documents(table), "documents")
    frequency = lsh.stage(sh.document_frequency(sh.shingle_rows(docs)), "frequency")
    bands = lsh.stage(lsh.band_rows(lsh.signature_parts(sh.shingle_rows(docs))), "bands")
    for crowd in (2, 64):
        monkeypatch.setattr(lsh, "CROWD", crowd)
        name = f"index_{crowd}"
        lsh.store_index(bands, docs, frequency, name, 16)
        for literals in (0, 4096):
            monkeypatch.setattr(lsh, "LITERAL_KEYS", literals)
            batch = docs.filter("doc % 11 = 0")
            keys = lsh.stage(lsh.band_rows(lsh.signature_parts(sh.shingle_rows(batch))), "keys")
            prefixes = lsh.rare_prefixes(batch, frequency)
            found = rows(lsh.indexed_lookup(keys, prefixes, name))
            wanted = lsh.lookup(bands, batch.select("doc"), docs, frequency).select("incoming_doc", "stored_doc", "shared_bands")
            assert found == rows(wanted) and len(found) > 5
    stored = spark.table("index_64_keys")
    key = stored.select("meeting_key").first()[0]
    one = lsh._rows_of(stored, spark.createDataFrame([(key,)], "meeting_key string"), "meeting_key")
    # a join on the key takes the table as it is stored
    monkeypatch.setattr(lsh, "LITERAL_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lsh._rows_of(stored, stored.select("meeting_key").limit(50), "meeting_key")
        plan = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "formatted")
        assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a lookup opens the file of its key only: it doesn't notice that all others are broken
    (hit,) = {r.path for r in one.select(F.col("_metadata.file_path").alias("path")).collect()}
    folder, name = os.path.split(hit.removeprefix("file:").replace("//", "/"))
    others = [f for f in os.listdir(folder) if f.endswith(".parquet") and f != name]
    assert len(others) == 15
    for other in others:
        os.remove(f"{folder}/.{other}.crc")
        with open(f"{folder}/{other}", "wb") as file:
            file.write(b"broken")
    assert one.count() >= 1
    with pytest.raises(Exception, match="parquet"):
        stored.agg(F.max("doc")).collect()
    for part in ("keys", "prefixes", "crowds"):
        for crowd in (2, 64):
            spark.sql(f"DROP TABLE index_{crowd}_{part}")


def test_batch_scores_agree_with_column_expressions(spark):
    """Scores of whole batches equal those of the column expressions, also on odd texts."""
    texts = [None, "", "a", "a b", "a b a b", "one two  three", "x_y z w", "aaaa", "abcde", "abcdef", "Ωμέγα \U0001f600ab",
             "\U0001f600" * 7, "a\nb c d", "the same words the same words again"]
    data = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    scored = tx.set_jaccard(tx.word_bigrams(F.col("a")), tx.word_bigrams(F.col("b")))
    columns = [(sets.pair_jaccard(F.col("a"), F.col("b")), scored)]
    for k, keep in ((5, True), (3, False)):
        both = [tx.char_kgrams(F.col(c), k, keep) for c in "ab"]
        columns.append((sets.kgram_jaccard(F.col("a"), F.col("b"), k, keep), tx.set_jaccard(*both)))
    for new, old in columns:
        pairs = data.select("a", "b", new.alias("new"), old.alias("old")).collect()
        assert all(r.new == r.old for r in pairs), [r for r in pairs if r.new != r.old][:3]


def test_minima_combine_over_batches(spark):
    """Minima of rows in any order equal a plain computation; no row is multiplied by the parts in the JVM."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        table = [(d, f"s{(d or 9) * k % 23}") for k in range(40) for d in (1, 2, None)] + [(3, None)]
        found = lsh.signature_parts(spark.createDataFrame(table, "doc long, shingle string"), lsh.OLDER)
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
        got = {(r.doc, r.part): list(r)[2:] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = minhash.coefficients(lsh.OLDER.parts * lsh.OLDER.width)
    assert len(got) == 4 * lsh.OLDER.parts
    for (doc, part), values in got.items():
        hashes = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for d, s in table if d == doc and s]
        mine = pairs[part * lsh.OLDER.width : (part + 1) * lsh.OLDER.width]
        assert values == [min(((h * a + b) % minhash.PRIME for h in hashes), default=None) for a, b in mine]


def test_texts_are_spread_before_they_are_cut_up(spark):
    docs = spark.createDataFrame([("a", 1, "x y z"), ("b", 1, "y z")], "doc string, n_copies bigint, clean string")
    made = sh.shingle_rows(docs.coalesce(1))
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert made.count() == 3


def test_stop_list_is_broadcast_whatever_the_threshold(spark, rows):
    docs = spark.createDataFrame([("a", 1, "x y z"), ("b", 1, "y z")], "doc string, n_copies bigint, clean string")
    stop = spark.createDataFrame([("y z", 2)], "shingle string, df bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = sh.prune(sh.shingle_rows(docs), stop)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert rows(kept, "doc", "shingle") == [("a", "x y")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keyed_character_runs_equal_those_by_pair(spark, rows):
    texts = {"a": "abcdefgh", "b": "abcdefxy", "c": "", "d": "abc", "e": "ab€cdefgh", "f": "ab€cdefg"}
    documents = spark.createDataFrame([*texts.items(), ("b", "abcdefgh")], "doc string, clean string")
    pairs = spark.createDataFrame([(x, y) for x in texts for y in texts if x < y], "doc_a string, doc_b string")
    keyed = rs.score_pairs(pairs, documents, lambda made, schema: sets.keyed_kgram_jaccard(made, schema, 3, True))
    score = sets.kgram_jaccard(F.col("text_a"), F.col("text_b"), 3, keep_short=True)
    by_pair = rs.attach_text(pairs, documents, "doc_a", "doc_b").select("doc_a", "doc_b", score)
    assert rows(keyed) == rows(by_pair)


def test_unpruned_buckets_sign_stop_shingles_only_once_more(spark, rows, tmp_path, monkeypatch):
    texts = [(doc, text, "en", "src9", len(text)) for doc, text in corpus(families=6)]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    signed, parts = [], lsh.signature_parts

    def counted(shingles, layout=lsh.DEFAULT):
        signed.append(shingles.count())
        return parts(shingles, layout)

    monkeypatch.setattr(lsh, "signature_parts", counted)
    found = {pruned: rows(queries.notice_bands(spark, str(tmp_path), pruned)) for pruned in (False, True)}
    shingles = sh.shingle_rows(sh.every_notice(queries.cleaned(spark, str(tmp_path))))
    assert sum(signed) == shingles.count() and len(signed) == 2 and min(signed) > 0
    assert found[False] == rows(lsh.band_rows(parts(shingles)))
    assert found[True] == rows(lsh.band_rows(parts(sh.prune(shingles, queries.stop(spark, str(tmp_path))))))


def test_noise_patterns_look_ahead_and_match_as_without(spark):
    draw = random.Random(4)
    tokens = ["Ref", "ref-12/a", "12-3-2024", "1.2.99", "7 Mar 2024", "12 dec 24", "Rs. 4,500.00", "inr 5 lakh", "tnx", "é12-1-24",
              "mc", "PWD9", "x", " ", "-", ".", "€", "３-4-5", "rupees", "99", "_"]
    texts = ["".join(draw.choice(tokens) + draw.choice(["", " ", "  "]) for _ in range(14)) for _ in range(300)]
    data = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string")
    for pattern in tx.NOISE_PATTERNS:
        plain = re.sub(r"\(\?=[^)]*\)", "", pattern)
        assert plain != pattern
        both = data.select(F.regexp_replace("t", pattern, "#").alias("a"), F.regexp_replace("t", plain, "#").alias("b"))
        assert both.filter("NOT a <=> b").isEmpty() and not both.filter("a LIKE '%#%'").isEmpty()
    blanked = F.regexp_replace("t", r"[^\x00-\x7F\p{L}\p{N}]", " ")
    folded = data.select(tx.fold_ascii(F.col("t")).alias("a"), F.regexp_replace(blanked, r"[^\x00-\x7F]", "_").alias("b"))
    assert folded.filter("NOT a <=> b").isEmpty()
