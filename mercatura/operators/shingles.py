"""Documents as shingle rows, document frequency, and pruning of corpus-wide stop shingles.

A *document* here is one distinct cleaned text: ``doc`` (the smallest notice id that carries it),
``n_copies`` and ``clean``. Exact copies are collapsed before anything pairs documents up, so a text
copied into a third of the corpus costs one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mercatura.functions.text import word_bigrams

# Fixed value: shingles in more than this share of the notices are boilerplate.
MAX_SHARE = 0.10


def distinct_documents(cleaned: DataFrame) -> DataFrame:
    """One row per non-empty cleaned text; copies meet in map tasks before the shuffle."""
    return (
        cleaned.filter("clean <> ''")
        .groupBy("clean")
        .agg(F.min("notice_id").alias("doc"), F.count("*").alias("n_copies"))
        .select("doc", "n_copies", "clean")
    )


def every_notice(cleaned: DataFrame) -> DataFrame:
    """The same shape without collapsing copies, for measures defined on notices."""
    return cleaned.select(
        F.col("notice_id").alias("doc"), F.lit(1).cast("bigint").alias("n_copies"), "clean"
    )


def spread(documents: DataFrame, key: str = "doc") -> DataFrame:
    """The same rows in as many tasks as a shuffle has, however few files or row groups they are read from.

    Patterns and shingles take far longer than reading a text, and many times its memory.
    """
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return documents.repartition(tasks, key)


def shingle_rows(documents: DataFrame, shingles: Column | None = None) -> DataFrame:
    """One row per document and distinct shingle.

    ``explode_outer`` and a null filter, since a plain ``explode`` makes the optimizer evaluate the
    whole array expression a second time to test its size.
    """
    sets = word_bigrams(F.col("clean")) if shingles is None else shingles
    return spread(documents).select("doc", "n_copies", F.explode_outer(sets).alias("shingle")).filter(
        F.col("shingle").isNotNull()
    )


def document_frequency(rows: DataFrame) -> DataFrame:
    """Number of notices holding each shingle."""
    return rows.groupBy("shingle").agg(F.sum("n_copies").alias("df"))


def stop_shingles(
    frequency: DataFrame, notices: DataFrame, max_share: float = MAX_SHARE
) -> DataFrame:
    """Shingles held by strictly more than ``max_share`` of the notices."""
    total = notices.agg(F.count("*").alias("n")).scalar()
    return frequency.filter(F.col("df") / total > max_share)


def prune(rows: DataFrame, stop: DataFrame) -> DataFrame:
    """Shingle rows without the stop shingles.

    Each notice holds its own shingles only, so no more than their mean number divided by ``MAX_SHARE`` are in that
    share of the notices, whatever the number of notices: the list is small and is always broadcast.
    """
    return rows.join(F.broadcast(stop.select("shingle")), "shingle", "left_anti")


def pruned_away(rows: DataFrame, stop: DataFrame) -> DataFrame:
    """The shingle rows that ``prune`` leaves out."""
    return rows.join(F.broadcast(stop.select("shingle")), "shingle", "left_semi")
