"""Point-in-time lookups against versioned dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from mercatura.operators.dims import valid_on
from mercatura.session import stage


def join_version(
    facts: DataFrame,
    versions: DataFrame,
    code: str,
    day: str,
    how: str = "left",
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """Facts with the version of ``code`` valid on ``day``.

    An equi-join on the code with the interval as residual condition: Spark broadcasts the versions
    when it measures them as small and shuffles on the code when not, splitting a hot code by itself.
    """
    f, v = facts.alias("f"), versions.withColumnRenamed(code, f"version_{code}").alias("v")
    match = (F.col(f"f.{code}") == F.col(f"v.version_{code}")) & valid_on(
        F.col(f"f.{day}"), F.col(f"v.{start}"), F.col(f"v.{end}")
    )
    return f.join(v, match, how).drop(f"version_{code}")


# Facts of a code beyond this number are spread over several groups.
GROUP_ROWS = 1_000_000


def last_version(
    facts: DataFrame,
    versions: DataFrame,
    code: str,
    day: str,
    start: str = "valid_from",
    end: str = "valid_to",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``join_version`` without an interval in a join: each fact takes the last version to start before it.

    For versions too large to broadcast. Facts and versions of a code lie in one sorted group, where a running last
    value carries the version; it counts where it has not ended. Versions of a code must not overlap (see
    ``dims.overlapping_versions``); where they do, the one that starts last is taken, and of equal starts the one that
    sorts last. A fact without code or day gets no version. A code with more than ``group_rows`` facts is spread over
    groups by a hash of its rows, and each group has all versions of the code, so no group grows with the facts; the
    number of groups comes from a count of all facts by code.
    """
    counts = facts.groupBy(code).agg(F.count("*").alias("n")).filter(F.col("n") > group_rows)
    hot = stage(counts.select(code, F.ceil(F.col("n") / group_rows).cast("int").alias("n_groups")), "hot_codes")
    n_groups = F.coalesce("n_groups", F.lit(1))
    group = F.pmod(F.xxhash64(*(F.col(f"fact.{c}") for c in facts.columns)), n_groups).cast("int")
    given = [c for c in versions.columns if c != code]

    def spread(rows: DataFrame) -> DataFrame:
        return rows.withColumnRenamed(code, "code").join(hot.withColumnRenamed(code, "code"), "code", "left")

    fact_rows = spread(facts.select(F.col(code), F.struct(*facts.columns).alias("fact"))).select(
        "code", group.alias("group"), F.col(f"fact.{day}").alias("at"), F.lit(True).alias("is_fact"), "fact"
    )
    version_rows = spread(versions.select(F.col(code), F.struct(*given).alias("version"))).filter("code IS NOT NULL").select(
        "code", F.explode(F.sequence(F.lit(0), n_groups - 1)).alias("group"), F.col(f"version.{start}").alias("at"),
        F.lit(False).alias("is_fact"), "version",
    )
    both = fact_rows.unionByName(version_rows, allowMissingColumns=True)
    so_far = Window.partitionBy("code", "group").orderBy(F.col("at").asc_nulls_first(), "is_fact", "version")
    carried = both.withColumn(
        "carried", F.last("version", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    ).filter("is_fact")
    valid = F.when(valid_on(F.col("at"), F.col(f"carried.{start}"), F.col(f"carried.{end}")), F.col("carried"))
    return carried.withColumn("valid", valid).select("fact.*", *(F.col(f"valid.{c}").alias(c) for c in given))


def prices_as_of(
    products: DataFrame,
    categories: DataFrame,
    prices: DataFrame,
    as_of: dt.date | str,
    codes: list[str] | None = None,
) -> DataFrame:
    """Prices in force on one date, of all codes or of those listed.

    Both validity tests are filters on their own table, so they reach its scan before anything is joined.
    """
    day = F.to_date(F.lit(str(as_of)))
    current = products.filter(valid_on(day, F.col("valid_from"), F.col("valid_to")))
    if codes is not None:
        current = current.filter(F.col("product_code").isin(*codes))
    in_force = prices.filter(valid_on(day, F.col("effective_from"), F.col("effective_to")))
    return (
        in_force.join(current.select("product_sk", "product_code", "product_name", "category_id"), "product_sk")
        .join(categories.select("category_id", "category_name"), "category_id")
        .select(
            "product_code",
            "product_name",
            "category_name",
            F.col("selling_price").alias("price"),
            F.col("mrp").alias("list_price"),
            F.col("effective_from").alias("price_since"),
            F.col("effective_to").alias("price_until"),
            day.alias("as_of"),
        )
    )


def price_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of price between two dates, matched on the code."""
    b, a = before.alias("b"), after.alias("a")
    old, new = F.col("b.price"), F.col("a.price")
    drift = (new - old).cast("double")
    return b.join(a, "product_code").select(
        "product_code",
        F.col("b.product_name").alias("product_name"),
        old.cast("double").alias("price_before"),
        new.cast("double").alias("price_after"),
        F.col("b.list_price").cast("double").alias("mrp_before"),
        F.col("a.list_price").cast("double").alias("mrp_after"),
        F.round(drift, 2).alias("drift"),
        F.round(F.try_divide(drift, old.cast("double")) * 100, 1).alias("drift_pct"),
    )
