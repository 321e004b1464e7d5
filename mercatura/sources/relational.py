"""Tables read in place from a relational database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """How to split a table into parallel range reads."""

    column: str
    lower: int
    upper: int
    count: int


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    slices: Slices | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A lazy table: Spark sends the projection and the simple filters to the database.

    Without ``slices`` one task reads everything, which suits master data only.
    """
    options = {"fetchsize": str(fetch_size), "pushDownPredicate": "true", **(properties or {})}
    if slices is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(
        url,
        table,
        column=slices.column,
        lowerBound=slices.lower,
        upperBound=slices.upper,
        numPartitions=slices.count,
        properties=options,
    )
