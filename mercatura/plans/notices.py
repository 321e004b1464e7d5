"""Near-duplicate queries over the driver's documents, and the end-to-end resolution job."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercatura.functions import sets, text as tx
from mercatura.operators import evaluate, lsh, nights, register, resolve as rs, shingles as sh
from mercatura.session import new_table_path, share, stage, stage_once
from mercatura.sources import standins

WIDEST = lsh.Layout(bands=64, rows=4)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned notices; like the tables below, stored by the first query that needs them."""
    return stage_once(
        spark, sf_dir, "cleaned", lambda: standins.cleaned_notices(spark, sf_dir)
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(
        spark, sf_dir, "documents", lambda: sh.distinct_documents(cleaned(spark, sf_dir))
    )


def frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(
        spark, sf_dir, "frequency", lambda: sh.document_frequency(sh.shingle_rows(documents(spark, sf_dir)))
    )


def stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(
        spark,
        sf_dir,
        "stop",
        lambda: sh.stop_shingles(frequency(spark, sf_dir), standins.notices(spark, sf_dir)),
    )


def kept_rows(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = documents(spark, sf_dir) if docs is None else docs
    return sh.prune(sh.shingle_rows(docs), stop(spark, sf_dir))


def signature_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.signature_parts(kept_rows(spark, sf_dir))


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(
        spark, sf_dir, "bands", lambda: lsh.band_rows(signature_parts(spark, sf_dir))
    )


def notice_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of every notice, copies included."""
    return stage_once(
        spark,
        sf_dir,
        "notice_parts",
        lambda: lsh.signature_parts(kept_rows(spark, sf_dir, sh.every_notice(cleaned(spark, sf_dir)))),
    )


def notice_bands(spark: SparkSession, sf_dir: str, pruned: bool = True) -> DataFrame:
    """The bucket table over every notice, copies included.

    A minimum over all shingles is the smaller one of those over the kept ones and over the stop shingles, so only
    the latter are signed again for the unpruned table.
    """

    def build() -> DataFrame:
        parts = notice_parts(spark, sf_dir)
        if not pruned:
            rows = sh.shingle_rows(sh.every_notice(cleaned(spark, sf_dir)))
            stopped = lsh.signature_parts(sh.pruned_away(rows, stop(spark, sf_dir)))
            parts = lsh.least_parts(parts.unionByName(stopped))
        return lsh.band_rows(parts)

    return stage_once(spark, sf_dir, "pruned_bands" if pruned else "all_bands", build)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(spark, sf_dir, "labelled", lambda: standins.labelled_pairs(spark, sf_dir))


def _as_docs(pairs: DataFrame) -> DataFrame:
    return pairs.withColumnsRenamed({"notice_id_a": "doc_a", "notice_id_b": "doc_b"})


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs with their Jaccard on cleaned word bigrams."""
    texts = cleaned(spark, sf_dir).select(F.col("notice_id").alias("doc"), "clean")
    pairs = _as_docs(labelled(spark, sf_dir))
    scored = rs.score_pairs(pairs.select("doc_a", "doc_b").distinct(), texts)
    return pairs.join(scored, ["doc_a", "doc_b"]).select("doc_a", "doc_b", "label", "raw_jaccard", "jaccard")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        tables = (table(spark, sf_dir) for table in (cleaned, documents, frequency, bands))
        return rs.resolve_stored(*tables)

    return stage_once(spark, sf_dir, "members", build)


# --- registered queries ---------------------------------------------------------------------------


def _digest(items: Column) -> Column:
    return F.md5(F.array_join(F.array_sort(items), "|"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.cleaned_notices(spark, sf_dir)


def clean_text_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.notices(spark, sf_dir).select(
        "notice_id", tx.clean_text_simple(F.col("body")).alias("clean")
    )


def word_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = cleaned(spark, sf_dir).select("notice_id", tx.word_bigrams(F.col("clean")).alias("grams"))
    return grams.select(
        "notice_id", F.size("grams").alias("n_grams"), _digest(F.col("grams")).alias("grams_md5")
    )


def char_kgrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character runs of length 5 on raw text, and of length 3 on the older cleaned text."""
    grams = standins.notices(spark, sf_dir).select(
        "notice_id",
        tx.raw_char_kgrams(F.col("body"), 5).alias("raw5"),
        tx.char_kgrams(tx.clean_text_simple(F.col("body")), 3, keep_short=False).alias("clean3"),
    )
    return grams.select(
        "notice_id",
        F.size("raw5").alias("n_raw5"),
        _digest(F.col("raw5")).alias("raw5_md5"),
        F.size("clean3").alias("n_clean3"),
        _digest(F.col("clean3")).alias("clean3_md5"),
    )


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs on character runs of the older cleaned text; an unknown notice scores 0."""
    texts = clean_text_simple(spark, sf_dir)

    both = rs.attach_text(labelled(spark, sf_dir), texts, "notice_id_a", "notice_id_b", "left")
    sides = (F.coalesce(side, F.lit("")) for side in ("text_a", "text_b"))
    score = sets.kgram_jaccard(*sides, 3, keep_short=False)
    return both.select(
        "notice_id_a", "notice_id_b", "label", F.round(score, 9).alias("jaccard")
    )


def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sh.document_frequency(sh.shingle_rows(documents(spark, sf_dir)))


def stop_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stop(spark, sf_dir)


def df_pruned_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        kept_rows(spark, sf_dir)
        .groupBy("doc", "n_copies")
        .agg(F.count("*").alias("n_kept"), F.min("shingle").alias("first_shingle"))
    )


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.signature_values(signature_parts(spark, sf_dir))


def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.band_rows(signature_parts(spark, sf_dir))


def lsh_bands_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older layout: 14 bands of 9 rows over character runs of length 3."""
    docs = clean_text_simple(spark, sf_dir)
    rows = sh.shingle_rows(
        sh.every_notice(docs), tx.char_kgrams(F.col("clean"), 3, keep_short=False)
    )
    return lsh.band_rows(lsh.signature_parts(rows, lsh.OLDER), lsh.OLDER)


def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that share a bucket."""
    return lsh.bucket_pairs(bands(spark, sf_dir))


def verified_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pairs = lsh.candidate_pairs(bands(spark, sf_dir), docs, frequency(spark, sf_dir))
    copies = docs.select("doc", "n_copies")
    return (
        rs.verify(pairs, docs)
        .join(copies.toDF("doc_a", "copies_a"), "doc_a")
        .join(copies.toDF("doc_b", "copies_b"), "doc_b")
        .withColumn("jaccard", F.round("jaccard", 9))
    )


def bucket_skew_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.largest_buckets(notice_bands(spark, sf_dir))


def bucket_skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets, implied pairs, the ten largest sizes, and the sources inside the largest bucket."""
    table = notice_bands(spark, sf_dir)
    summary = lsh.skew_summary(table, CAPS[-1]).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("measure"),
                        F.lit("").alias("item"),
                        F.col(name).cast("double").alias("amount"),
                    )
                    for name in ("n_buckets", "largest_bucket", "implied_pairs")
                ]
            )
        )
    )
    ten = lsh.largest_buckets(table, 10)
    sizes = ten.agg(F.sort_array(F.collect_list("n_members"), asc=False).alias("sizes")).select(
        F.lit("size_by_rank").alias("measure"),
        F.posexplode("sizes").alias("rank", "amount"),
    )
    inside = (
        table.join(lsh.largest_buckets(table, 1).select(*lsh.BUCKET), lsh.BUCKET, "left_semi")
        .join(standins.notices(spark, sf_dir), F.col("doc") == F.col("notice_id"))
        .groupBy("portal_id")
        .agg(F.count("*").alias("n"))
        .select(
            F.lit("source_in_largest").alias("measure"),
            F.col("portal_id").alias("item"),
            F.col("n").cast("double").alias("amount"),
        )
    )
    return summary.unionByName(
        sizes.select(
            "measure",
            (F.col("rank") + 1).cast("string").alias("item"),
            F.col("amount").cast("double").alias("amount"),
        )
    ).unionByName(inside)


# Bucket sizes at which a cap is reported.
CAPS = (2, 100)


def hot_bucket_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cap on bucket size would keep and what it would cost, over the whole bucket table."""
    table = notice_bands(spark, sf_dir)
    reports = [lsh.skew_summary(table, cap).withColumn("cap", F.lit(cap)) for cap in CAPS]
    return reports[0].unionByName(reports[1])


def shared_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _as_docs(labelled(spark, sf_dir)).select("doc_a", "doc_b", "label")
    return lsh.with_shared_bands(pairs, notice_bands(spark, sf_dir), "doc_a", "doc_b")


def retrieval_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall on pairs labelled same, with every bucket and with buckets up to a cap."""
    table = notice_bands(spark, sf_dir)
    pairs = _as_docs(labelled(spark, sf_dir)).select("doc_a", "doc_b", "label")
    counted = stage(lsh.with_kept_bands(pairs, table, "doc_a", "doc_b", CAPS), "shared")
    reports = [
        evaluate.retrieval_recall(counted, "shared", f"kept_{cap}").withColumn("cap", F.lit(cap))
        for cap in CAPS
    ]
    return reports[0].unionByName(reports[1])


def mitigation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket table and recall without and with pruning of stop shingles."""
    pairs = _as_docs(labelled(spark, sf_dir)).select("doc_a", "doc_b", "label")
    reports = []
    for name, pruned in (("unpruned", False), ("pruned", True)):
        table = notice_bands(spark, sf_dir, pruned)
        shared = lsh.with_shared_bands(pairs, table, "doc_a", "doc_b", "shared")
        recall = evaluate.retrieval_recall(shared, "shared", "shared")
        reports.append(
            lsh.skew_summary(table, CAPS[-1])
            .select("n_buckets", "largest_bucket", "implied_pairs")
            .select(
                F.lit(name).alias("variant"),
                "*",
                recall.select("recall_before").scalar().alias("recall"),
            )
        )
    return reports[0].unionByName(reports[1])


def lsh_s_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lsh.with_shared_bands(
        scored_labels(spark, sf_dir), notice_bands(spark, sf_dir), "doc_a", "doc_b", "shared"
    )
    return evaluate.curve_report(scored, "shared")


def _reviewed(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Documents with a reviewed copy, in the part of an incoming batch."""
    reviewed = cleaned(spark, sf_dir).join(
        standins.table(spark, sf_dir, "labels"), F.col("notice_id") == F.col("doc_id"), "left_semi"
    )
    texts = reviewed.select(F.sha2("clean", 256).alias("digest")).distinct()
    return docs.select("doc", F.sha2("clean", 256).alias("digest")).join(
        texts, "digest", "left_semi"
    ).select("doc")


def lsh_lookup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under review looked up among all others through the bucket table."""
    docs = documents(spark, sf_dir)
    return lsh.lookup(
        bands(spark, sf_dir),
        stage(_reviewed(spark, sf_dir, docs), "batch"),
        docs,
        frequency(spark, sf_dir),
    )


def index_name(spark: SparkSession, sf_dir: str) -> str:
    """Name of the stored index of these tables, built by the first query that needs it."""

    def build() -> str:
        name = f"buckets_{uuid.uuid4().hex}"
        lsh.store_index(bands(spark, sf_dir), documents(spark, sf_dir), frequency(spark, sf_dir), name)
        return name

    return share(spark, sf_dir, "index", build)


def lsh_lookup_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of ``lsh_lookup_batch`` looked up through the stored index, from its own texts alone."""
    docs = documents(spark, sf_dir)
    batch = stage(docs.join(_reviewed(spark, sf_dir, docs), "doc", "left_semi"), "batch")
    keys = stage(lsh.band_rows(lsh.signature_parts(kept_rows(spark, sf_dir, batch))), "keys")
    prefixes = stage(lsh.rare_prefixes(batch, frequency(spark, sf_dir)), "batch_prefixes")
    return lsh.indexed_lookup(keys, prefixes, index_name(spark, sf_dir))


def clusters_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters after two nights: the first knows the notices without a review only, the second adds the others.

    So late copies, documents that get another id and a moving stop list occur as the tables have them.
    """
    texts = cleaned(spark, sf_dir)
    reviewed = standins.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("notice_id")).distinct()
    first = nights.first_night(texts.join(reviewed, "notice_id", "left_anti"))
    second = nights.next_night(first, texts.join(reviewed, "notice_id", "left_semi"))
    return nights.members_of(second, texts)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir)


def cluster_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.size_histogram(members(spark, sf_dir))


def alias_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of a first run, which knew exact copies only, replaced by the full run."""
    return rs.new_aliases(rs.copy_clusters(cleaned(spark, sf_dir)), members(spark, sf_dir))


def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = rs.copy_clusters(cleaned(spark, sf_dir))
    return rs.resolve_bookmarks(before, alias_update(spark, sf_dir))


# The stricter similarity of the middle one of three nights.
STRICT = 0.75


def alias_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the identifiers of three nights lead: exact copies, close texts, and the full run, one after the other."""
    texts, docs = cleaned(spark, sf_dir), documents(spark, sf_dir)
    found = rs.match_components(bands(spark, sf_dir), docs, frequency(spark, sf_dir), STRICT)
    runs = [rs.copy_clusters(texts), stage(rs.cluster_members(texts, docs, found), "close_members"), members(spark, sf_dir)]
    log = None
    for night, (before, after) in enumerate(zip(runs, runs[1:]), 2):
        log = rs.logged_aliases(log, rs.new_aliases(before, after), after, night)
    return rs.resolve_chains(log)


def cluster_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three stored tables after three runs: exact copies of the notices without a review, the full run, and
    exact copies of all, which takes the full run's clusters apart again."""
    texts = cleaned(spark, sf_dir)
    reviewed = standins.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("notice_id")).distinct()
    unreviewed = texts.join(reviewed, "notice_id", "left_anti")
    root = new_table_path(spark, "register")
    for night, run in enumerate((rs.copy_clusters(unreviewed), members(spark, sf_dir), rs.copy_clusters(texts)), 1):
        register.record_run(run, f"night {night}", root)
    tables = (register.OPPORTUNITIES, register.MEMBERS, register.ALIASES)
    shown = [
        register.read(spark, root, columns).toDF("id", "target", "since").withColumn("entry", F.lit(columns[0]))
        for columns in tables
    ]
    return reduce(DataFrame.unionByName, shown)


def score_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.separation(
        scored_labels(spark, sf_dir),
        {"raw_char_5": "raw_jaccard", "clean_word_2": "jaccard"},
    )


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_sweep(scored_labels(spark, sf_dir))


def minhash_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sh.shingle_rows(sh.every_notice(cleaned(spark, sf_dir)))
    return evaluate.estimator_error(
        scored_labels(spark, sf_dir), lsh.signature_parts(rows, WIDEST), WIDEST
    )


def label_base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.base_rate(members(spark, sf_dir), labelled(spark, sf_dir))


def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.pair_quality(members(spark, sf_dir), labelled(spark, sf_dir))


def source_volume(spark: SparkSession, sf_dir: str, top: int = 15) -> DataFrame:
    """Notices of the largest sources, beside the number of sources."""
    per_source = standins.notices(spark, sf_dir).groupBy("portal_id").agg(F.count("*").alias("n_notices"))
    n_sources = per_source.agg(F.count("*").alias("n")).scalar()
    return (
        per_source.withColumn("n_sources", n_sources)
        .orderBy(F.desc("n_notices"), "portal_id")
        .limit(top)
    )


QUERIES = {
    "clean_text": clean_text,
    "clean_text_simple": clean_text_simple,
    "word_bigrams": word_bigrams,
    "char_kgrams": char_kgrams,
    "pair_scores": pair_scores,
    "score_separation": score_separation,
    "doc_frequency": doc_frequency,
    "stop_shingles": stop_shingles,
    "df_pruned_shingles": df_pruned_shingles,
    "minhash_signature": minhash_signature,
    "minhash_error": minhash_error,
    "lsh_bands": lsh_bands,
    "lsh_bands_older": lsh_bands_older,
    "lsh_s_curve": lsh_s_curve,
    "lsh_candidates": lsh_candidates,
    "lsh_lookup_batch": lsh_lookup_batch,
    "lsh_lookup_indexed": lsh_lookup_indexed,
    "shared_bands": shared_bands,
    "verified_pairs": verified_pairs,
    "threshold_sweep": threshold_sweep,
    "bucket_skew_topk": bucket_skew_topk,
    "bucket_skew_profile": bucket_skew_profile,
    "hot_bucket_cap": hot_bucket_cap,
    "retrieval_recall": retrieval_recall,
    "mitigation_report": mitigation_report,
    "clusters": clusters,
    "clusters_incremental": clusters_incremental,
    "cluster_histogram": cluster_histogram,
    "alias_update": alias_update,
    "alias_resolve": alias_resolve,
    "alias_chain": alias_chain,
    "cluster_register": cluster_register,
    "cluster_quality": cluster_quality,
    "label_base_rate": label_base_rate,
    "source_volume": source_volume,
}
