"""The sales fact and the revenue slices over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercatura.functions.money import is_revenue, line_amount, total
from mercatura.operators.asof import join_version

UNKNOWN_PRODUCT = 0


def sales_fact(lines: DataFrame, products: DataFrame, lookup=join_version) -> DataFrame:
    """Revenue lines with the product key valid on the day; unmatched codes go to the default member.

    ``lookup`` is ``asof.join_version``, or ``asof.last_version`` for a product table too large to broadcast.
    """
    versions = products.select("product_code", "product_sk", "valid_from", "valid_to")
    sold = lines.filter(is_revenue(F.col("line_type")))
    return lookup(sold, versions, "product_code", "business_date").select(
        "bill_no",
        "line_no",
        "store_id",
        F.coalesce("product_sk", F.lit(UNKNOWN_PRODUCT)).alias("product_sk"),
        F.col("business_date").alias("date_key"),
        "line_type",
        "qty",
        "unit_price",
        line_amount(F.col("qty"), F.col("unit_price")).alias("line_amount"),
    )


def revenue_by_store(fact: DataFrame, stores: DataFrame, top: int = 5) -> DataFrame:
    """Aggregated per store first: only one row per store reaches the join."""
    per_store = fact.groupBy("store_id").agg(
        total(F.col("line_amount")).alias("net_revenue"),
        F.countDistinct("bill_no").alias("total_bills"),
    )
    return (
        per_store.join(stores.select("store_id", "store_name", "city"), "store_id")
        .orderBy(F.desc("net_revenue"), "store_id")
        .limit(top)
    )


def revenue_by_category(
    fact: DataFrame, products: DataFrame, categories: DataFrame, top: int = 6
) -> DataFrame:
    """Aggregated per product key first, so the joins see one row per product."""
    per_product = fact.groupBy("product_sk").agg(
        F.sum("line_amount").alias("amount"), F.sum(F.col("qty").cast("decimal(18,3)")).alias("units")
    )
    return (
        per_product.join(products.select("product_sk", "category_id"), "product_sk")
        .join(categories, "category_id")
        .groupBy("category_name", "department")
        .agg(
            total(F.col("amount")).alias("net_revenue"),
            F.round(F.sum("units"), 0).cast("bigint").alias("total_units_sold"),
        )
        .orderBy(F.desc("net_revenue"), "category_name")
        .limit(top)
    )


def revenue_by_weekday(fact: DataFrame, dates: DataFrame) -> DataFrame:
    days = dates.select("date_key", "day_of_week_num", "day_of_week_name")
    return (
        fact.join(days, "date_key")
        .groupBy("day_of_week_num", "day_of_week_name")
        .agg(
            total(F.col("line_amount")).alias("net_revenue"),
            F.countDistinct("bill_no").alias("total_bills"),
        )
        .orderBy("day_of_week_num")
        .drop("day_of_week_num")
    )


def revenue_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    per_day = fact.groupBy("date_key").agg(F.sum("line_amount").alias("amount"))
    days = dates.select("date_key", "year_month", "month_name")
    return (
        per_day.join(days, "date_key")
        .groupBy("year_month", "month_name")
        .agg(total(F.col("amount")).alias("net_revenue"))
        .orderBy("year_month")
    )


def top_store_categories(
    lake: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    year_month: str,
    top: int = 10,
) -> DataFrame:
    """Store and category revenue of one lake month against master tables kept elsewhere.

    Inner on the product version, so lines of codes unknown to the masters (bill discounts) drop out.
    """
    sold = lake.filter((F.col("year_month") == year_month) & is_revenue(F.col("line_type")))
    versions = products.select("product_code", "category_id", "valid_from", "valid_to")
    return (
        join_version(sold, versions, "product_code", "business_date", how="inner")
        .join(categories.select("category_id", "category_name"), "category_id")
        .join(stores.select("store_id", "store_name", "city"), "store_id")
        .groupBy("store_name", "city", "category_name")
        .agg(
            total(line_amount(F.col("qty"), F.col("unit_price"))).alias("revenue"),
            F.countDistinct("bill_no").alias("bill_count"),
        )
        .orderBy(F.desc("revenue"), "store_name", "category_name")
        .limit(top)
    )


def bill_rounded_revenue(fact: DataFrame) -> DataFrame:
    """The finance convention: each bill rounded to a whole unit, then summed by month."""
    bills = fact.groupBy("bill_no", F.date_format("date_key", "yyyy-MM").alias("month")).agg(
        F.sum("line_amount").alias("bill_total")
    )
    return bills.groupBy("month").agg(
        F.sum(F.round("bill_total", 0)).cast("decimal(38,2)").cast("double").alias("bill_rounded_revenue"),
        total(F.col("bill_total")).alias("line_revenue"),
    )
