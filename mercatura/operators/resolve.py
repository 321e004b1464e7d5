"""Exact verification, connected components, stable identifiers and aliases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from mercatura.functions import sets
from mercatura.operators import lsh
from mercatura.operators.joins import join_by_key
from mercatura.operators.shingles import (
    distinct_documents,
    document_frequency,
    prune,
    shingle_rows,
    stop_shingles,
)
from mercatura.session import cut_lineage, stage

PREFIX = "OPP_"


def attach_text(
    pairs: DataFrame, texts: DataFrame, a: str, b: str, how: str = "inner"
) -> DataFrame:
    """Pairs with the texts of both sides.

    Texts travel, not shingle sets: a set is several times the text it comes from.
    """
    key, text = texts.columns
    return pairs.join(
        texts.select(F.col(key).alias(a), F.col(text).alias("text_a")), a, how
    ).join(texts.select(F.col(key).alias(b), F.col(text).alias("text_b")), b, how)


# Documents with pairs among each other are scored by the square of this number.
TILE = 256


def score_pairs(
    pairs: DataFrame,
    documents: DataFrame,
    score: Callable[[DataFrame, T.StructType], DataFrame] = sets.keyed_jaccard,
) -> DataFrame:
    """Exact Jaccard of ``doc_a, doc_b``, on unpruned word bigrams unless another ``score`` is given.

    Texts travel by tile of pairs, not by pair: documents are kept beside those they share their smallest partner
    with, cut by ``TILE``, and the texts of two cuts meet once for all pairs between them.
    """
    pairs = stage(pairs.select("doc_a", "doc_b").filter("doc_a IS NOT NULL AND doc_b IS NOT NULL"), "pairs")
    sides = [pairs.select(F.col(doc).alias("doc"), F.least("doc_a", "doc_b").alias("hub")) for doc in ("doc_a", "doc_b")]
    hubs = sides[0].unionByName(sides[1]).groupBy("doc").agg(F.min("hub").alias("hub"))
    cuts = hubs.groupBy("hub").agg(F.ceil(F.count("*") / TILE).alias("cuts"))
    at = F.xxhash64("hub", F.pmod(F.xxhash64("doc"), "cuts"))
    tiles = stage(join_by_key(hubs, cuts, ["hub"]).select("doc", at.alias("tile")), "tiles")
    keyed = (
        pairs.join(tiles.toDF("doc_a", "tile_a"), "doc_a")
        .join(tiles.toDF("doc_b", "tile_b"), "doc_b")
        .select(F.xxhash64("tile_a", "tile_b").alias("key"), "doc_a", "doc_b")
    )
    keyed = stage(keyed, "keyed")
    needed = keyed.select("key", F.col("doc_a").alias("doc")).union(keyed.select("key", "doc_b")).distinct()
    texts = needed.join(documents.select("doc", F.col("clean").alias("text")), "doc")
    rows = texts.select("key", "doc", "text").unionByName(keyed, allowMissingColumns=True)
    in_a_row = rows.repartition("key").sortWithinPartitions("key", F.col("doc").isNull())
    return score(in_a_row, pairs.schema.add("jaccard", "double"))


def verify(
    pairs: DataFrame, documents: DataFrame, threshold: float = lsh.MERGE_THRESHOLD
) -> DataFrame:
    return score_pairs(pairs, documents).filter(F.col("jaccard") >= threshold)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node on an edge: ``node, component``.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until every edge points at a
    root. Each round is checkpointed; only the answer to that question reaches the driver.
    """
    a, b = edges.columns
    current = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct()
    )
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            join_by_key(both, lowest, ["u"])
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            join_by_key(large, lowest, ["u"])
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = cut_lineage(small)
        roots = current.select(F.col("v").alias("node")).distinct()
        if roots.join(current.select(F.col("u").alias("node")), "node", "left_semi").isEmpty():
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def bucket_stars(bands: DataFrame) -> DataFrame:
    """Each bucket member with the smallest member of its bucket: linear in the bucket rows."""
    pivots = bands.groupBy(*lsh.BUCKET).agg(F.min("doc").alias("doc_a"), F.count("*").alias("n"))
    return (
        join_by_key(bands, pivots.filter("n > 1").drop("n"), lsh.BUCKET)
        .filter("doc <> doc_a")
        .select("doc_a", F.col("doc").alias("doc_b"))
        .distinct()
    )


def mixed_buckets(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket rows of buckets whose members do not all carry one label yet."""
    label = F.coalesce("label", F.col("doc"))
    spans = (
        bands.join(labels, "doc", "left")
        .groupBy(*lsh.BUCKET)
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .filter("low <> high")
    )
    return join_by_key(bands, spans.select(*lsh.BUCKET), lsh.BUCKET, "left_semi")


def match_components(
    bands: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    threshold: float = lsh.MERGE_THRESHOLD,
) -> DataFrame:
    """Components of all candidate pairs reaching ``threshold``.

    Members are first compared with the smallest member of each of their buckets. Only pairs whose sides are
    still apart can change a component, so only buckets that still mix components are then paired up, and
    only across components. A crowd of near copies is settled by the first, linear step.
    """
    first = verify(bucket_stars(bands), documents, threshold)
    labels = cut_lineage(
        connected_components(first.select("doc_a", "doc_b")).toDF("doc", "label")
    )
    mixed = stage(mixed_buckets(bands, labels), "mixed")
    if mixed.isEmpty():
        return labels.withColumnRenamed("label", "component")
    apart = lsh.candidate_pairs(mixed, documents, frequency, labels, threshold)
    return _merge(labels.toDF("doc", "component"), verify(apart, documents, threshold))


def _merge(components: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after adding edges: only the components the edges touch are walked again."""
    owner = components.select("doc", "component")
    links = (
        edges.select("doc_a", "doc_b")
        .join(owner.toDF("doc_a", "owner_a"), "doc_a", "left")
        .join(owner.toDF("doc_b", "owner_b"), "doc_b", "left")
        .select(
            F.coalesce("owner_a", "doc_a").alias("a"), F.coalesce("owner_b", "doc_b").alias("b")
        )
    )
    merged = connected_components(links).toDF("component", "root")
    nodes = owner.unionByName(merged.select(F.col("component").alias("doc"), "component")).distinct()
    return join_by_key(nodes, merged, ["component"], "left").select(
        "doc", F.coalesce("root", "component").alias("component")
    )


def extend_components(
    components: DataFrame,
    bands: DataFrame,
    incoming: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    threshold: float = lsh.MERGE_THRESHOLD,
) -> DataFrame:
    """Components after a batch arrives; ``bands`` and ``documents`` already hold the batch.

    Pairs of stored documents were settled by earlier runs and are not formed again.
    """
    pairs = lsh.batch_pairs(bands, incoming, documents, frequency, True, threshold)
    return _merge(components, verify(pairs, documents, threshold))


def cluster_members(cleaned: DataFrame, documents: DataFrame, components: DataFrame) -> DataFrame:
    """Every notice with its opportunity, named after the smallest notice id of the cluster."""
    keyed = documents.select(F.sha2("clean", 256).alias("digest"), "doc")
    owner = keyed.join(components, "doc", "left").select(
        "digest", F.coalesce("component", "doc").alias("canonical")
    )
    return (
        cleaned.select("notice_id", F.sha2("clean", 256).alias("digest"))
        .join(owner, "digest", "left")
        .select("notice_id", F.coalesce("canonical", "notice_id").alias("canonical_notice_id"))
        .withColumn("opportunity_id", F.concat(F.lit(PREFIX), F.col("canonical_notice_id")))
    )


def copy_clusters(cleaned: DataFrame) -> DataFrame:
    """Clusters of exact copies only."""
    documents = distinct_documents(cleaned)
    nothing = documents.select("doc", F.col("doc").alias("component")).limit(0)
    return cluster_members(cleaned, documents, nothing)


def resolve(
    cleaned: DataFrame,
    threshold: float = lsh.MERGE_THRESHOLD,
    layout: lsh.Layout = lsh.DEFAULT,
) -> DataFrame:
    """Cleaned notices to cluster members. Documents and bands are written once and then reread."""
    cleaned = stage(cleaned, "cleaned")
    documents = stage(distinct_documents(cleaned), "documents")
    rows = shingle_rows(documents)
    frequency = stage(document_frequency(rows), "frequency")
    kept = prune(rows, stage(stop_shingles(frequency, cleaned), "stop"))
    bands = stage(lsh.band_rows(lsh.signature_parts(kept, layout), layout), "bands")
    return resolve_stored(cleaned, documents, frequency, bands, threshold)


def resolve_stored(
    cleaned: DataFrame,
    documents: DataFrame,
    frequency: DataFrame,
    bands: DataFrame,
    threshold: float = lsh.MERGE_THRESHOLD,
) -> DataFrame:
    """As ``resolve``, from stored tables of the notices."""
    components = match_components(bands, documents, frequency, threshold)
    return cluster_members(cleaned, documents, components)


def opportunities(members: DataFrame, run_at: str, known: DataFrame | None = None) -> DataFrame:
    """The clusters of a run: ``opportunity_id, canonical_notice_id, first_seen_at``, kept from ``known``."""
    now = members.select("opportunity_id", "canonical_notice_id").distinct()
    return _since(now, "first_seen_at", run_at, known, ["opportunity_id"])


def memberships(members: DataFrame, run_at: str, known: DataFrame | None = None) -> DataFrame:
    """Who is in which cluster: ``notice_id, opportunity_id, joined_at``; a move starts a new membership."""
    now = members.select("notice_id", "opportunity_id")
    return _since(now, "joined_at", run_at, known, ["notice_id", "opportunity_id"])


def dated_aliases(aliases: DataFrame, run_at: str, known: DataFrame | None = None) -> DataFrame:
    """The alias table: ``old_opportunity_id, active_opportunity_id, merged_at``, the time of the first merge."""
    return _since(aliases, "merged_at", run_at, known, ["old_opportunity_id"])


def _since(now: DataFrame, name: str, run_at: str, known: DataFrame | None, key: list[str]) -> DataFrame:
    """Rows of a run with the time since when their key is known."""
    if known is None:
        return now.withColumn(name, F.lit(run_at))
    before = known.select(*key, F.col(name).alias("before"))
    return now.join(before, key, "left").select(
        *now.columns, F.coalesce("before", F.lit(run_at)).alias(name)
    )


def new_aliases(before: DataFrame, after: DataFrame) -> DataFrame:
    """Identifiers that no longer stand for themselves: ``old_opportunity_id, active_opportunity_id``.

    A cluster that was split follows the smallest identifier its members now have.
    """
    moved = before.select("notice_id", F.col("opportunity_id").alias("old_opportunity_id")).join(
        after.select("notice_id", F.col("opportunity_id").alias("active_opportunity_id")),
        "notice_id",
    )
    return (
        moved.groupBy("old_opportunity_id")
        .agg(F.min("active_opportunity_id").alias("active_opportunity_id"))
        .filter("old_opportunity_id <> active_opportunity_id")
    )


def merge_aliases(existing: DataFrame, new: DataFrame, after: DataFrame) -> DataFrame:
    """Alias table after a run: older entries are redirected, so one lookup always resolves.

    An identifier that a cluster of ``after`` carries again, as after a split, stands for itself: its entry goes.
    """
    step = new.select(
        F.col("old_opportunity_id").alias("active_opportunity_id"),
        F.col("active_opportunity_id").alias("next"),
    )
    redirected = existing.join(step, "active_opportunity_id", "left").select(
        "old_opportunity_id", F.coalesce("next", "active_opportunity_id").alias("active_opportunity_id")
    )
    kept = redirected.join(new.select("old_opportunity_id"), "old_opportunity_id", "left_anti")
    live = after.select(F.col("opportunity_id").alias("old_opportunity_id")).distinct()
    return (
        kept.unionByName(new)
        .filter("old_opportunity_id <> active_opportunity_id")
        .join(live, "old_opportunity_id", "left_anti")
    )


def logged_aliases(log: DataFrame | None, new: DataFrame, after: DataFrame, night: int) -> DataFrame:
    """The log of all nights' aliases with one more: ``night, old_opportunity_id, active_opportunity_id``.

    An identifier that a cluster of ``after`` carries again is logged as its own, so it stands for itself from
    then on.
    """
    entry = new.select(F.lit(night).alias("night"), "old_opportunity_id", "active_opportunity_id")
    if log is None:
        return entry
    live = after.select(F.col("opportunity_id").alias("old_opportunity_id")).distinct()
    back = log.select("old_opportunity_id").distinct().join(live, "old_opportunity_id").select(
        F.lit(night).alias("night"), "old_opportunity_id", F.col("old_opportunity_id").alias("active_opportunity_id")
    )
    return log.unionByName(entry).unionByName(back)


def resolve_chains(log: DataFrame) -> DataFrame:
    """The end of every chain of aliases, and its steps: ``old_opportunity_id, active_opportunity_id, n_steps``.

    Of several entries for an identifier the latest counts. Every round replaces an entry's target by the
    target's own, so chains halve in length each time; a chain of more steps than there are entries goes in a
    circle, which is an error.
    """
    latest = log.groupBy("old_opportunity_id").agg(
        F.max(F.struct("night", "active_opportunity_id")).getField("active_opportunity_id").alias("active_opportunity_id")
    )
    entries = latest.filter("old_opportunity_id <> active_opportunity_id")
    current = cut_lineage(entries.withColumn("n_steps", F.lit(1).cast("bigint")))
    n_entries = current.count()
    while True:
        further = current.toDF("active_opportunity_id", "next", "more")
        joined = current.join(further, "active_opportunity_id", "left")
        round_ = stage(joined.select("old_opportunity_id", "active_opportunity_id", "next", "n_steps", "more"), "chains")
        if round_.filter("next IS NOT NULL").isEmpty():
            return round_.select("old_opportunity_id", "active_opportunity_id", "n_steps")
        circle = round_.filter(F.col("next").isNotNull() & (F.col("n_steps") > n_entries)).first()
        if circle:
            raise ValueError(f"the aliases of {circle.old_opportunity_id} lead back to one of them")
        current = round_.select(
            "old_opportunity_id",
            F.coalesce("next", "active_opportunity_id").alias("active_opportunity_id"),
            (F.col("n_steps") + F.coalesce("more", F.lit(0))).alias("n_steps"),
        )


def resolve_bookmarks(members: DataFrame, aliases: DataFrame) -> DataFrame:
    """Members with the identifier now active for the one they were filed under."""
    return members.join(
        aliases.select(F.col("old_opportunity_id").alias("opportunity_id"), "active_opportunity_id"),
        "opportunity_id",
        "left",
    ).select(
        "notice_id",
        F.col("opportunity_id").alias("filed_under"),
        F.coalesce("active_opportunity_id", "opportunity_id").alias("opportunity_id"),
    )


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("opportunity_id").agg(F.count("*").alias("size"))


def size_histogram(members: DataFrame) -> DataFrame:
    return (
        cluster_sizes(members)
        .groupBy("size")
        .agg(F.count("*").alias("n_clusters"))
        .withColumn("n_notices", F.col("size") * F.col("n_clusters"))
        .withColumn(
            "duplicate_pairs",
            (lsh.pairs_within(F.col("size")).cast("double") * F.col("n_clusters")).cast("double"),
        )
    )
