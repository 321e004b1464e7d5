"""Dimensions: calendar, default members, and checks of versioned (validity-dated) members."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from mercatura.schemas import CATEGORY, PRODUCT

OPEN_END = dt.date(9999, 12, 31)

# The members that receive bill-level discounts.
DISCOUNT_CATEGORY = ("C00", "Bill Discounts", "Discounts", 0.0)
DISCOUNT_PRODUCT = (
    0, "DISC", "Bill Discount", "C00", "RetailEdge", "1", "EA",
    dt.date(2000, 1, 1), OPEN_END, True,
)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the ``first_day`` and ``last_day`` of a one-row table, both included."""
    day = F.col("date_key")
    days = bounds.select(
        F.explode(F.expr("sequence(first_day, last_day, interval 1 day)")).alias("date_key")
    )
    weekday = F.dayofweek(day) - 1
    return days.select(
        "date_key",
        F.date_format(day, "yyyy-MM-dd").alias("full_date"),
        weekday.alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.year(day).alias("calendar_year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def year_bounds(dates: DataFrame, column: str) -> DataFrame:
    """First day of the first year and last day of the last year seen in ``column``."""
    lowest, highest = F.min(column), F.max(column)
    return dates.agg(
        F.make_date(F.year(lowest), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year(highest), F.lit(12), F.lit(31)).alias("last_day"),
    )


def _with_member(dim: DataFrame, member: tuple, schema) -> DataFrame:
    """A dimension with one more row, made of literals on a one-row range: Spark knows the size of that."""
    values = [F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(member, schema)]
    return dim.unionByName(dim.sparkSession.range(1).select(*values))


def with_discount_category(categories: DataFrame, member: tuple = DISCOUNT_CATEGORY) -> DataFrame:
    return _with_member(categories, member, CATEGORY)


def with_discount_product(products: DataFrame, member: tuple = DISCOUNT_PRODUCT) -> DataFrame:
    return _with_member(products, member, PRODUCT)


def reissued_codes(products: DataFrame) -> DataFrame:
    """Codes carried by more than one product."""
    return (
        products.groupBy("product_code")
        .agg(F.count("*").alias("n_products"))
        .filter("n_products > 1")
    )


def overlapping_versions(products: DataFrame, key: str = "product_code") -> DataFrame:
    """Versions starting before the previous one of their key has ended; such a code fans out a fact."""
    from pyspark.sql import Window

    versions = Window.partitionBy(key).orderBy("valid_from", "valid_to")
    before = F.max("valid_to").over(versions.rowsBetween(Window.unboundedPreceding, -1))
    return products.withColumn("previous_end", before).filter("valid_from <= previous_end")


def valid_on(day: Column, start: Column, end: Column) -> Column:
    """Validity intervals include both ends."""
    return (day >= start) & (day <= end)
