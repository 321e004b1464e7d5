"""Registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.llm import (
    codes, decontaminate, grammar, jaccard, lm, negatives, packing, pii, quality, substrings, tokens, topk, urls,
    wordpiece,
)
from mercatura.llm.common import read
from mercatura.session import new_table_path

#: Fixed values of the query on urls.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


#: Tokenizer files of the queries.
WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def definition(name: str) -> str:
    return tokens.read_definition(public_tokenizers.path(name))


def held_out(doc_id: Column) -> Column:
    """Whether a label is kept back from fitting: the CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fitted_quality(spark: SparkSession, sf_dir: str) -> quality.Field | None:
    labels = read(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return quality.fit(read(spark, sf_dir, "documents"), labels)


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(read(spark, sf_dir, "documents"), fitted_quality(spark, sf_dir))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy pieces of the byte vocabulary, in which a blank marks a word's start."""
    pieces = wordpiece.byte_level_pieces(definition(BYTE_TOKENIZER))
    return wordpiece.count_pieces(read(spark, sf_dir, "documents"), pieces, mark=b" ")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        read(spark, sf_dir, "documents"), definition(WORD_TOKENIZER), end_id=2, keep_ids=False
    )
    return pieces.drop("ids")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"), RULES)


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "tokens")
    grammar.write_tokens(read(spark, sf_dir, "documents"), path, definition(WORD_TOKENIZER), end_id=1)
    found = grammar.read_tokens(spark, path)
    return found.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read(spark, sf_dir, "documents"), size=13, first=7)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), n=4, share=(85, 100))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label, k=5, share=(80, 100))


def op13_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"), definition(BYTE_RANKS), parts=5, kept_back=1)


QUERIES = {
    "op1_quality_crf": op1_quality_crf,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_url_filter": op4_url_filter,
    "op5_pii_spans": op5_pii_spans,
    "op6_token_files": op6_token_files,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_decontamination": op9_decontamination,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_vector_codes": op11_vector_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_attention_scores": op13_attention_scores,
}
