"""Re-sent lines: keep-latest deduplication, its profile, and the checksum that proves a reload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LINE_KEY = ("bill_no", "line_no")


def keep_latest(lines: DataFrame, key=LINE_KEY, latest: str = "raw_ts") -> DataFrame:
    """One row per key: the latest, with every other column as tie-break so re-runs agree.

    Spark limits each map task to one row per key before the shuffle, so a line re-sent without end
    still reaches its reducer as one row per task.
    """
    ties = [c for c in lines.columns if c not in key and c != latest]
    order = [F.col(c).desc_nulls_last() for c in (latest, *ties)]
    ranked = lines.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("rn = 1").drop("rn")


def with_month(lines: DataFrame) -> DataFrame:
    return lines.withColumn("year_month", F.date_format("business_date", "yyyy-MM"))


def duplicate_profile(lines: DataFrame, key=LINE_KEY) -> DataFrame:
    """Raw lines, distinct keys and the surplus, from per-key counts."""
    per_key = lines.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("raw_lines"),
        F.count("*").alias("unique_lines"),
        (F.sum("n") - F.count("*")).alias("surplus_lines"),
        F.max("n").alias("most_copies"),
    )


def rest_of_line() -> Column:
    """The text of a line without its key; null where nothing else is known."""
    parts = [
        F.col("product_code"),
        F.col("qty").cast("decimal(18,2)").cast("string"),
        F.col("unit_price").cast("decimal(18,2)").cast("string"),
        F.col("line_type"),
    ]
    return F.when(F.coalesce(*parts).isNotNull(), F.concat_ws(":", *parts))


def line_text(rest: str | None = None) -> Column:
    """A line as text; ``rest`` names a column that has its text without the key."""
    after = rest_of_line() if rest is None else F.col(rest)
    return F.concat_ws(":", "bill_no", F.col("line_no").cast("string"), after)


def checksums(rows: DataFrame, keys=(), row_text: Column | None = None) -> DataFrame:
    """Row count and an order-free content checksum of each group of ``keys``; without keys, of the whole table.

    The MD5 of each row is cut in four words, the words are summed, and the sums are hashed. Sums merge,
    so nothing is sorted or gathered; repeated rows count, which an exclusive-or would cancel.
    """
    digest = F.md5(line_text() if row_text is None else row_text)
    words = [
        F.sum(F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(20,0)")).alias(f"w{at}")
        for at in (1, 9, 17, 25)
    ]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("row_count"), *words)
    parts = [F.coalesce(F.col(f"w{at}"), F.lit(0)).cast("string") for at in (1, 9, 17, 25)]
    return sums.select(
        *keys, "row_count", F.md5(F.concat_ws(":", F.col("row_count").cast("string"), *parts)).alias("checksum")
    )


def table_checksum(lines: DataFrame, row_text: Column | None = None) -> DataFrame:
    """Row count and checksum of a table, see ``checksums``."""
    return checksums(lines, (), row_text)


def line_type_breakdown(lines: DataFrame, amount: Column) -> DataFrame:
    from mercatura.functions.money import total

    return lines.groupBy("line_type").agg(
        F.count("*").alias("n_lines"), total(amount).alias("amount")
    )
