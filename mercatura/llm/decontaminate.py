"""Benchmark decontamination with a distributed positional inverted index.

A phrase is a window of consecutive words of a benchmark item. All training words that the benchmark uses are
counted, so each phrase knows its rarest terms. The index stores the places of the two rarest terms of every
phrase in the training texts: (term, document, position). The places of the rarest give possible starts, which
are intersected with the places of the second rarest at its offset in the phrase. What is left is small; in the
documents that hold it, the places of all the phrase's other terms are compared too. With ``slop`` each term may
stand that many words from its place in the phrase, which finds proximity matches.

Everything is DataFrame operations. Small sides are broadcast only where Spark's size checks choose so;
intermediate tables are written, so their sizes are known.

Words are maximal runs of letters and digits, where every non-ASCII character counts as a letter, with A-Z
lower-cased. An item of fewer than ``size`` words, but not none, is one window. A null or empty text has no
words, no hits and no items; null items are ignored. Of an item id that occurs twice all texts count. Rows that
share an id and a text are alike; rows that share an id only are judged one by one. A null document id is an
id like others; a null item id is left out of the list of items. Empty tables are allowed on both sides. Only
the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.llm.urls import LOWER, UPPER
from mercatura.session import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def folded(text: Column) -> Column:
    """A text with A-Z lower-cased; ``lower``, which is faster, does the same where all characters are ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def term_array(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a separator at either end leaves an empty string there."""
    return F.split(folded(text), SEPARATORS)


def word_count(text: Column) -> Column:
    parts = F.split(text, SEPARATORS)
    edges = (F.element_at(parts, 1) == "").cast("long")
    last = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.coalesce(F.size(parts).cast("long") - edges - last, F.lit(0).cast("long"))


def placed_terms(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Every word with its position: the keys, pos, term.

    The text is cut once, by ``posexplode``: whether it begins with a separator is seen from its first character.
    """
    text = F.col(text_col)
    lead = F.substring(text, 1, 1).rlike(f"^{SEPARATORS}").cast("int")
    return (
        rows.filter(text.isNotNull())
        .select(*keys, lead.alias("lead"), F.posexplode(F.split(text, SEPARATORS)).alias("place", "term"))
        .filter("term <> ''")
        .select(*keys, (F.col("place") - F.col("lead")).alias("pos"), folded(F.col("term")).alias("term"))
    )


def windows(benchmark: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows of all items: item, window (its words, joined)."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()
    )
    words = items.select("item", F.filter(term_array(F.col("text")), lambda w: w != "").alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        words.filter(F.size("words") > 0)
        .select("item", "words", F.explode(starts).alias("first"))
        .select("item", F.slice("words", F.col("first"), size).alias("words"))
        .select("item", F.array_join("words", " ").alias("window"))
        .distinct()
    )


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Places of the given terms: doc, digest, pos, term. ``texts``: doc, digest, text."""
    return placed_terms(texts, ["doc", "digest"], "text").join(terms, "term", "left_semi")


def ranked_terms(phrases: DataFrame, texts: DataFrame) -> DataFrame:
    """Terms of each phrase with offset, rank (the rarest in the texts first) and the phrase's number of terms.

    Phrases that hold a term which no text has are dropped. ``phrases``: phrase (a number), window.
    """
    placed = stage(
        phrases.select("phrase", F.posexplode(F.split("window", " ")).alias("offset", "term")), "phrase_terms"
    )
    vocabulary = stage(placed.select("term").distinct(), "vocabulary")
    counts = stage(postings(texts, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("count")), "frequencies")
    whole = Window.partitionBy("phrase")
    known = placed.join(counts, "term", "left").withColumns(
        {
            "rank": F.row_number().over(whole.orderBy("count", "offset")),
            "complete": F.min(F.col("count").isNotNull()).over(whole),
            "n": F.count(F.lit(1)).over(whole),
        }
    )
    return known.filter("complete").select("phrase", "term", "offset", "rank", "n")


def _near(rows: DataFrame, slop: int) -> DataFrame:
    """Each start and term once for every place ``pos`` that a match allows."""
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop))) if slop else F.lit(0)
    return rows.withColumn("shift", shifts).withColumn("pos", F.col("start") + F.col("offset") + F.col("shift"))


def _renamed(rows: DataFrame) -> DataFrame:
    """The right side of a join, with an underscore behind each name."""
    return rows.select(*(F.col(c).alias(f"{c}_") for c in rows.columns))


def _same(*names: str) -> Column:
    """Equality with the renamed side on ``doc``, which may be null, and on the named columns."""
    equal = F.col("doc").eqNullSafe(F.col("doc_"))
    for name in names:
        equal = equal & (F.col(name) == F.col(f"{name}_"))
    return equal


def find_phrases(texts: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Occurrences of phrases: phrase, doc, digest, start, n (its words). ``texts``: doc, digest, text.

    With slop 0 they are exact; else each term may stand up to ``slop`` words off its place, counted from
    the start that the rarest term gives.
    """
    terms = stage(ranked_terms(phrases, texts), "terms")
    first, second = (stage(terms.filter(F.col("rank") == k), "seeds") for k in (1, 2))
    seeds = stage(first.unionByName(second).select("term").distinct(), "seed_terms")
    index = stage(postings(texts, seeds), "index")
    found = (
        index.join(first.select("phrase", "term", "offset", "n"), "term")
        .select("phrase", "doc", "digest", (F.col("pos") - F.col("offset")).alias("start"), "n")
        .filter(F.col("start") >= -slop)
    )
    asked = _near(found.join(second.select("phrase", "term", "offset"), "phrase"), slop)
    places = index.join(second.select("term").distinct(), "term", "left_semi")
    columns = ["phrase", "doc", "digest", "start", "n"]
    agreed = asked.join(_renamed(places), _same("digest", "pos", "term"), "left_semi").select(*columns)
    found = stage(agreed.unionByName(found.filter("n = 1")).distinct(), "candidates")
    # of all other terms only the places in documents that are left
    held = stage(found.select("doc", "digest").distinct(), "documents")
    rest = terms.filter("rank > 2").select("phrase", "term", "offset")
    others = stage(rest.select("term").distinct(), "other_terms")
    places = postings(texts.join(_renamed(held), _same("digest"), "left_semi"), others)
    asked = _near(found.join(rest, "phrase"), slop)
    met = asked.join(_renamed(places), _same("digest", "pos", "term"), "left_semi")
    whole = (
        met.select(*columns, "offset").distinct().groupBy(*columns).agg(F.count(F.lit(1)).alias("met"))
        .filter(F.col("met") == F.col("n") - 2)
    )
    return whole.select(*columns).unionByName(found.filter("n <= 2"))


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    slop: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row its id, a digest of its text, n_words, n_hit (words inside a match) and items (sorted text ids)."""
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).withColumn(
        "digest", F.xxhash64("text")
    )
    of_items = stage(windows(benchmark, size, item_col, item_text_col), "windows")
    numbered = of_items.select("window").distinct().withColumn("phrase", F.monotonically_increasing_id())
    phrases = stage(numbered, "phrases")
    matches = stage(find_phrases(texts, phrases, slop), "matches")
    last = F.col("start") + F.col("n").cast("int") - 1
    head = F.greatest("start", F.lit(0))  # with slop a match may start before the text
    covered = matches.select("doc", "digest", F.explode(F.sequence(head, last)).alias("pos"))
    n_hit = covered.distinct().groupBy("doc", "digest").agg(F.count(F.lit(1)).alias("n_hit"))
    items = (
        matches.select("doc", "digest", "phrase").distinct()
        .join(phrases, "phrase").join(of_items, "window")
        .groupBy("doc", "digest")
        .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    per_doc = n_hit.join(_renamed(items), _same("digest")).select("doc", "digest", "n_hit", "items_")
    base = texts.select("doc", "digest", word_count(F.col("text")).alias("n_words"))
    joined = base.join(_renamed(stage(per_doc, "hits")), _same("digest"), "left")
    return joined.select(
        F.col("doc").alias("doc_id"),
        "digest",
        "n_words",
        F.coalesce("n_hit_", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items__", F.array().cast("array<string>")).alias("items"),
    )
