"""Registered queries against their statements, and the pipeline against brute force."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
import oracle_check  # noqa: E402
from mercatura.llm import oracle, pii, queries, tokens  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from .test_decontaminate import brute as brute_hits  # noqa: E402
from .test_jaccard import brute as brute_components  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
@pytest.mark.parametrize("name", list(oracle.STATEMENTS))
def test_query_equals_statement(spark, name):
    assert oracle_check.compare(spark, oracle_check.tables(SF_DIR), name, SF_DIR).startswith("ok")


def documents():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    clean = ["\n".join(line(draw.randint(8, 20)) for _ in range(4)) for _ in range(90)]
    junk = ["\n".join(" | ".join(word().upper() + "!!" for _ in range(12)) for _ in range(4)) for _ in range(60)]
    benchmark = [(k, line(14)) for k in range(6)] + [(9, None), (10, "")]
    rows = [(k, t) for k, t in enumerate(clean + junk)]
    near = lambda t: t.replace(" ", " zz ", 1)
    rows += [(500 + k, near(t)) for k, t in enumerate(clean[:12])] + [(600 + k, t) for k, t in enumerate(clean[:9])]
    rows += [(700 + k, clean[20 + k] + "\n" + benchmark[k % 6][1]) for k in range(8)]
    rows += [(800, line(30) + " Write to some.one@mail.example.org now."), (900, None), (901, ""), (None, line(30))]
    rows += [(5, clean[5]), (5, clean[50])]
    return rows, benchmark


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    rows, benchmark = documents()
    docs = [(i, t, "xx", "s", len(t or ""), 1.0, "e") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string"
    spark.createDataFrame(docs, schema).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, int(k < 90), 0) for k in range(150)], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet"
    )
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_against_brute_force(spark, folder):
    rows, benchmark = documents()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality_classifier"](spark, docs, folder)
    assert good.columns == docs.columns
    kept = pairs(good)
    assert set(kept) <= set(rows)
    junk = {i for i in range(90, 150)}
    assert not junk & {i for i, _ in kept} and {t for _, t in rows if t and "|" not in t} <= {t for _, t in kept}

    good = corpus_pipeline.stage(good, "good")
    single = stages["ngram_jaccard_join"](spark, good, folder)
    assert single.columns == docs.columns
    lead = {}
    for i, _, c in brute_components(kept, 5, (80, 100)):
        lead[i] = c
    want = sorted({(i, t) for i, t in kept if i is not None and lead[i] == i} | {x for x in kept if x[0] is None}, key=repr)
    assert pairs(single) == want

    single = corpus_pipeline.stage(single, "single")
    safe = stages["benchmark_decontamination"](spark, single, folder)
    assert safe.columns == docs.columns
    hit = {(i, n) for i, n, h, _ in brute_hits(want, benchmark, 10, 0) if h}
    assert len(hit) >= 3 and len(want) - safe.count() == len(hit)
    assert not {i for i, _ in pairs(safe)} & {i for i, _ in hit}

    safe = corpus_pipeline.stage(safe, "safe")
    masked = stages["pii"](spark, safe, folder)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    after = masked.collect()
    expected = [(r.doc_id, r.text if r.text is None else pii.masked(r.text)) for r in safe.collect()]
    assert pairs(masked) == sorted(expected, key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
    assert any(r.doc_id == 800 and "[email]" in r.text for r in after)

    packed = stages["packing"](spark, corpus_pipeline.stage(masked, "masked"), folder).collect()
    whole = {}
    for r in sorted(packed, key=lambda r: r.start):
        whole[r.doc_id, r.doc_tokens] = whole.get((r.doc_id, r.doc_tokens), b"") + r.ids
    encode = tokens.Encoder(queries.definition(queries.WORD_TOKENIZER)).encode
    ids = [(r.doc_id, encode([r.text])[0] + np.array([2], "<u4").tobytes()) for r in after]
    assert whole == {(i, len(x) // 4): x for i, x in ids}


def test_run_and_empty_tables(spark, folder, tmp_path):
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 50 and got.agg(F.max("length")).first()[0] <= 4096
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_unique_text_of_a_linked_id_stays(spark, folder):
    text = "one two three four five six seven eight nine"
    unique = "a b c d e f g h i j"
    rows = [(3, text), (5, text), (5, unique), (5, unique), (6, text), (7, ""), (7, text), (None, text), (2, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, folder)
    want = [(3, text), (5, unique), (7, ""), (None, text), (2, "x y")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_columns_that_are_named_like_helpers_keep_their_values(spark, folder):
    text = "one two three four five six seven eight nine"
    names = ("document_key", "hit_id", "hit_digest", "_key", "block", "component_id")
    rows = [(k, t, *(f"{k}{n}" for n in names)) for k, t in ((3, text), (5, text), (6, "a b c"), (7, "d e f"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, folder)
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2], rows[3]]
    safe = corpus_pipeline.drop_contaminated(spark, docs, folder)
    assert sorted(map(tuple, safe.collect())) == rows
