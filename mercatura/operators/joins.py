"""Joins of rows with a table aggregated on the same key, when one key may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_by_key(rows: DataFrame, per_key: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``per_key``, in a form whose hot keys adaptive execution can split.

    An aggregate on the join key is already partitioned for the join, so Spark would not shuffle it
    again, and it only splits a skewed partition where both sides come out of a shuffle made for the
    join. A second join column, a function of the key, asks for that shuffle; it moves the aggregate,
    which has one narrow row per key, and lets the rows of a hot key spread over many tasks.
    """
    guard = F.pmod(F.xxhash64(*on), F.lit(1024))
    return (
        rows.withColumn("key_guard", guard)
        .join(per_key.withColumn("key_guard", guard), [*on, "key_guard"], how)
        .drop("key_guard")
    )
