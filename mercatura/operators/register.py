"""The register of clusters: stored opportunities, memberships and aliases, brought up to date by each run.

Only rows that a run adds or changes are upserted, so a quiet night rewrites few folders. Rows never leave the
register: an opportunity that is missing for a night keeps the time it was first seen, a notice that is missing
stays where it was. An identifier that is carried again after a merge gets itself as its alias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mercatura.operators import resolve
from mercatura.schemas import STRING
from mercatura.session import stage
from mercatura.sources import sinks

OPPORTUNITIES = ("opportunity_id", "canonical_notice_id", "first_seen_at")
MEMBERS = ("notice_id", "opportunity_id", "joined_at")
ALIASES = ("old_opportunity_id", "active_opportunity_id", "merged_at")


def read(spark: SparkSession, root: str, columns: tuple[str, ...]) -> DataFrame:
    """One of the three tables, all columns strings."""
    schema = T.StructType([T.StructField(c, STRING) for c in columns])
    return sinks.read_keyed(spark, f"{root}/{columns[0]}", schema).select(*columns)


def _changed_aliases(known: DataFrame, before: DataFrame, after: DataFrame, run_at: str) -> DataFrame:
    """Entries that a run adds or changes. ``merged_at`` is the time since which an identifier is merged, or since
    which it stands for itself again."""
    live = after.select(F.col("opportunity_id").alias("old_opportunity_id")).distinct()
    new = stage(resolve.new_aliases(before, after).join(live, "old_opportunity_id", "left_anti"), "new_aliases")
    merged = F.col("old_opportunity_id") != F.col("active_opportunity_id")
    since = known.filter(merged).select("old_opportunity_id", "merged_at")
    current = resolve.merge_aliases(known.filter(merged).drop("merged_at"), new, after).join(
        since, "old_opportunity_id", "left"
    )
    again = known.filter(merged).join(live, "old_opportunity_id").select(
        "old_opportunity_id", F.col("old_opportunity_id").alias("active_opportunity_id"), F.lit(run_at).alias("merged_at")
    )
    return current.withColumn("merged_at", F.coalesce("merged_at", F.lit(run_at))).unionByName(again)


def record_run(members: DataFrame, run_at: str, root: str, parts: int = sinks.KEY_PARTS) -> dict[str, list[int]]:
    """Enter the clusters of a run; returns the folders written of each table, named by its key.

    ``members`` has ``notice_id, canonical_notice_id, opportunity_id``. Memberships are written last: the run's
    aliases follow from those before it, so a run that stops half-way can be entered again.
    """
    spark = members.sparkSession
    ids = ("notice_id", "canonical_notice_id", "opportunity_id")
    now = stage(members.select(*(F.col(c).cast("string").alias(c) for c in ids)), "run_members")
    known = read(spark, root, MEMBERS)
    moved = now.join(known.select("notice_id", "opportunity_id"), ["notice_id", "opportunity_id"], "left_anti")
    entries = {
        ALIASES: (_changed_aliases(read(spark, root, ALIASES), known, now, run_at), "last"),
        OPPORTUNITIES: (
            now.select("opportunity_id", "canonical_notice_id").distinct().withColumn("first_seen_at", F.lit(run_at)),
            "first",
        ),
        MEMBERS: (moved.select("notice_id", "opportunity_id", F.lit(run_at).alias("joined_at")), "last"),
    }
    return {
        columns[0]: sinks.upsert_into(rows.select(*columns), f"{root}/{columns[0]}", [columns[0]], [columns[-1]], keep, parts)
        for columns, (rows, keep) in entries.items()
    }
