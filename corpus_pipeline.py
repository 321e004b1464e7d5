"""A training corpus from documents: quality, near duplicates, benchmark passages, personal data, packing.

Each stage reads what the one before it wrote. All but the last return the columns of ``documents``, with any
further ones that they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.llm import decontaminate, jaccard, packing, pii, quality, queries
from mercatura.llm.common import read
from mercatura.operators.joins import join_by_key
from mercatura.session import stage

#: Words of a shingle and least similarity of near duplicates; words of a benchmark window.
SHINGLE, SIMILARITY, BENCHMARK_WINDOW = 5, (80, 100), 10


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of the documents has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least one half."""
    field = queries.fitted_quality(spark, sf_dir)
    return docs.filter(quality.score_column(docs, F.col("text"), field) >= 0.5)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the ones with the smallest id; one row of equal id and text.

    Documents are told apart by id and text, so a text without links stays if another of its id goes.
    Documents without words or without an id are in no group and stay.
    """
    name = _free(docs, "document_key")
    keyed = docs.withColumn(name, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = stage(jaccard.jaccard_components(keyed, SHINGLE, SIMILARITY, name), "components")
    # members of groups of two or more; a group is named by its smallest key
    rest = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(name), "component_id").distinct()
    rest = stage(rest, "linked")
    linked = rest.unionByName(rest.select(F.col("component_id").alias(name), "component_id").distinct())
    members = stage(join_by_key(keyed.select(name, "doc_id"), linked, [name]).distinct(), "members")
    lowest = members.groupBy("component_id").agg(F.min("doc_id").alias("lowest"))
    others = join_by_key(members, lowest, ["component_id"]).filter("doc_id > lowest").select(name)
    kept = keyed.join(stage(others, "others"), name, "left_anti")
    several = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    several = stage(several.select(F.col("doc_id").alias(name)), "repeated")
    if several.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(several, name).dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return kept.join(several, name, "left_anti").select(*docs.columns).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.hits(docs, read(spark, sf_dir, "benchmark"), BENCHMARK_WINDOW)
    of_id, of_text = _free(docs, "hit_id"), _free(docs, "hit_digest")
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias(of_id), F.col("digest").alias(of_text))
    same = F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_text))
    return docs.join(stage(hit.distinct(), "contaminated"), same, "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each item of personal data replaced by its kind in brackets, and ``n_chars`` counted anew."""
    masked = docs.withColumn("text", pii.mask(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 ids, with the ids."""
    return packing.pack(docs, queries.definition(queries.WORD_TOKENIZER), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier and the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
