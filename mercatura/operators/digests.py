"""Digest tree of the lines of a load, and the partitions and lines in which two loads differ.

A leaf is the checksum of one store and month, a store's node that of its leaves, the root that of the stores. A
node is a checksum of rows that hold its children's keys and checksums, so every level merges and none is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercatura.operators import dedup

LEAF, STORE, ROOT = "month", "store", "root"
SHAPE = "level string, store_id string, year_month string, n_children bigint, row_count bigint, checksum string"


def _fold(nodes: DataFrame, keys: list[str], child: str) -> DataFrame:
    text = F.concat_ws(":", child, F.col("row_count").cast("string"), "checksum")
    folded = dedup.checksums(nodes, keys, text).withColumnRenamed("row_count", "n_children")
    counts = nodes.groupBy(*keys).agg(F.sum("row_count").alias("row_count"))
    return folded.join(counts, keys) if keys else folded.withColumn("row_count", F.coalesce(counts.scalar(), F.lit(0)))


def leaves(lines: DataFrame) -> DataFrame:
    """Row count and checksum of each store and month. ``lines`` has ``year_month``."""
    return dedup.checksums(lines, ("store_id", "year_month"))


def tree(leaf_rows: DataFrame) -> DataFrame:
    """The nodes above stored leaves, and the leaves: a row for each, the keys a node doesn't have null.

    An empty table has a root of no children.
    """
    stores = _fold(leaf_rows, ["store_id"], "year_month")
    root = _fold(stores.drop("n_children"), [], "store_id")
    nodes = (
        leaf_rows.withColumns({"level": F.lit(LEAF), "n_children": F.lit(0)}),
        stores.withColumns({"level": F.lit(STORE), "year_month": F.lit(None)}),
        root.withColumns({"level": F.lit(ROOT), "store_id": F.lit(None), "year_month": F.lit(None)}),
    )
    columns = [c.split() for c in SHAPE.split(", ")]
    shaped = [n.select(*(F.col(name).cast(kind).alias(name) for name, kind in columns)) for n in nodes]
    return shaped[0].unionByName(shaped[1]).unionByName(shaped[2])


def _changed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes whose checksums differ, or that only one side has."""
    sides = [
        side.select(*keys, F.col("row_count").alias(f"rows_{name}"), F.col("checksum").alias(f"sum_{name}"))
        for side, name in ((before, "before"), (after, "after"))
    ]
    joined = sides[0].join(sides[1], keys, "full")
    return joined.filter(~F.col("sum_before").eqNullSafe(F.col("sum_after"))).select(
        *keys, *(F.coalesce(f"rows_{name}", F.lit(0)).alias(f"rows_{name}") for name in ("before", "after"))
    )


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Stores and months in which two trees differ, with both row counts: ``store_id, year_month, rows_before,
    rows_after``. Leaves are compared for stores whose nodes differ only."""

    def level(nodes: DataFrame, name: str) -> DataFrame:
        return nodes.filter(F.col("level") == name)

    stores = _changed(level(before, STORE), level(after, STORE), ["store_id"]).select("store_id")
    below = [level(nodes, LEAF).join(stores, "store_id", "left_semi") for nodes in (before, after)]
    return _changed(*below, ["store_id", "year_month"])


def changed_lines(before: DataFrame, after: DataFrame, partitions: DataFrame) -> DataFrame:
    """Lines of ``partitions`` that one load has more often than the other, with what ``after`` has of them more
    (``surplus``, below zero where it has less). Other partitions are left out before anything is compared."""
    keys = ["store_id", "year_month"]
    columns = [*keys, "bill_no", "line_no", dedup.rest_of_line().alias("rest")]
    signed = [
        side.join(partitions.select(*keys), keys, "left_semi").select(*columns, F.lit(sign).alias("sign"))
        for side, sign in ((before, -1), (after, 1))
    ]
    # one line of a key and text stands for its copies; their prices may differ below what the text shows. The key is
    # shuffled once, beside the text and not in it too
    rows = signed[0].unionByName(signed[1])
    of_line = rows.groupBy(*keys, "bill_no", "line_no", "rest").agg(F.sum("sign").alias("surplus"))
    text = dedup.line_text("rest").alias("text")
    return of_line.filter("surplus <> 0").select(*keys, "bill_no", "line_no", text, "surplus")
