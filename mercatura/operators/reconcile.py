"""Reconciliation of pipeline revenue with signed-off figures, gaps in the feed, and causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercatura.functions.money import money, total

# Fixed value: differences below one cent agree.
TOLERANCE = 0.01
# Chance below which a run of days without lines is no habit of a store.
RARITY = 1e-4


def monthly_revenue(fact: DataFrame) -> DataFrame:
    per_day = fact.groupBy("date_key").agg(F.sum("line_amount").alias("amount"))
    return per_day.groupBy(F.date_format("date_key", "yyyy-MM").alias("month")).agg(
        total(F.col("amount")).alias("pipeline_revenue")
    )


def reconcile(pipeline: DataFrame, finance: DataFrame, how: str = "inner") -> DataFrame:
    """Variance by month, rounded half up. ``how='full'`` also shows months only one side has."""
    joined = pipeline.join(finance, "month", how)
    variance = (money(F.col("pipeline_revenue")) - money(F.col("revenue_inr"))).cast("double")
    share = F.try_divide(F.col("variance_inr"), F.col("revenue_inr")) * 100
    return (
        joined.withColumn("variance_inr", variance)
        .withColumn("variance_pct", F.round(share, 4))
        .withColumn(
            "status",
            F.when(F.col("pipeline_revenue").isNull(), "MISSING_IN_PIPELINE")
            .when(F.col("revenue_inr").isNull(), "MISSING_IN_FINANCE")
            .when(F.abs("variance_inr") < TOLERANCE, "MATCH")
            .otherwise("VARIANCE"),
        )
    )


def missing_days(lines: DataFrame, rarity: float = RARITY) -> DataFrame:
    """Days of the feed's span on which a store has no line: ``store_id, missing_day, lost``.

    Every store of the feed is held against the whole span, so a store that starts late or stops exporting
    shows. A day is ``lost`` if its run of missing days is too long to be the store's habit: a store that
    trades on a share p of the days has a run of n days without a line with a chance of ``(1 - p) ** n``, and
    the run is lost where that is below ``rarity``. Each store's calendar is generated from the span and what
    was observed is removed; nothing is crossed.
    """
    observed = lines.select("store_id", F.col("business_date").alias("day")).distinct()
    span = observed.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    stores = observed.groupBy("store_id").agg(F.count("*").alias("traded")).select(
        "store_id", "traded", first.alias("first"), last.alias("last")
    )
    habit = F.col("traded") / (F.datediff("last", "first") + 1)
    expected = stores.select(
        "store_id", habit.alias("habit"), F.explode(F.sequence("first", "last")).alias("day")
    )
    missing = expected.join(observed, ["store_id", "day"], "left_anti")
    by_store = Window.partitionBy("store_id").orderBy("day")
    runs = missing.withColumn("run", F.date_sub("day", F.row_number().over(by_store)))
    length = F.count("*").over(Window.partitionBy("store_id", "run"))
    return runs.select(
        "store_id",
        F.col("day").alias("missing_day"),
        (F.pow(1 - F.col("habit"), length) < rarity).alias("lost"),
    )


def classify_variance(reconciled: DataFrame, bill_rounded: DataFrame, missing: DataFrame) -> DataFrame:
    """Cause of each difference.

    A signed-off figure equal to the bill-rounded total is a rounding policy; failing that, lost store-days
    in the month are a gap in the source; failing that, the two sides count other things.
    """
    gaps = missing.filter("lost").groupBy(F.date_format("missing_day", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("lost_store_days")
    )
    rounded_equal = (
        F.abs(money(F.col("revenue_inr")) - money(F.col("bill_rounded_revenue"))) < TOLERANCE
    )
    return (
        reconciled.join(bill_rounded.select("month", "bill_rounded_revenue"), "month", "left")
        .join(gaps, "month", "left")
        .withColumn("lost_store_days", F.coalesce("lost_store_days", F.lit(0)))
        .withColumn(
            "cause",
            F.when(F.col("status") == "MATCH", "NONE")
            .when(rounded_equal, "ROUNDING_POLICY")
            .when(F.col("lost_store_days") > 0, "SOURCE_GAP")
            .otherwise("REVENUE_SCOPE"),
        )
    )


def weekday_profile(lines: DataFrame, fact: DataFrame, missing: DataFrame) -> DataFrame:
    """What a store takes on a weekday: ``store_id, weekday, amount, n_days``.

    Days it habitually stays closed count as days without revenue, lost days don't count.
    """
    traded = lines.select("store_id", F.col("business_date").alias("day")).distinct()
    closed = missing.filter("not lost").select("store_id", F.col("missing_day").alias("day"))
    weekday = F.weekday("day").alias("weekday")
    days = traded.unionByName(closed).groupBy("store_id", weekday).agg(F.count("*").alias("n_days"))
    sold = fact.groupBy("store_id", F.weekday("date_key").alias("weekday")).agg(F.sum("line_amount").alias("amount"))
    return days.join(sold, ["store_id", "weekday"], "left").withColumn(
        "amount", F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    )


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5).cast("bigint")


def variance_parts(
    reconciled: DataFrame, bill_rounded: DataFrame, missing: DataFrame, profile: DataFrame
) -> DataFrame:
    """The variance of each month in money by cause; the parts add up to it.

    ``source_gap_inr``: for each lost store-day, what the store takes on that weekday (``weekday_profile``), as
    revenue the feed lacks; of a weekday a store has no other day of, nothing. ``rounding_inr``: where the signed-off
    figure is a whole number, which one in a hundred others is by chance, line totals less bill-rounded totals,
    exact for the bills of the feed. ``scope_inr``: the rest, what the sides count differently and the error of the
    estimate. A month that agrees has no parts, and a month only one side has is scope as a whole.
    """
    month = F.date_format("missing_day", "yyyy-MM").alias("month")
    lost = missing.filter("lost").groupBy("store_id", month, F.weekday("missing_day").alias("weekday")).agg(
        F.count("*").alias("n_lost")
    )
    each = _cents(F.col("amount") * F.col("n_lost") / F.col("n_days"))
    gaps = lost.join(profile, ["store_id", "weekday"], "left").groupBy("month").agg(
        F.sum("n_lost").alias("lost_store_days"), F.coalesce(F.sum(each), F.lit(0)).alias("gap_cents")
    )
    whole = _cents(F.col("revenue_inr")) % 100 == 0
    of_bills = _cents(F.col("line_revenue")) - _cents(F.col("bill_rounded_revenue"))
    variance = F.coalesce(_cents(F.col("pipeline_revenue")), F.lit(0)) - F.coalesce(_cents(F.col("revenue_inr")), F.lit(0))
    both = F.col("status") == "VARIANCE"
    cents = (
        reconciled.join(bill_rounded.select("month", "line_revenue", "bill_rounded_revenue"), "month", "left")
        .join(gaps, "month", "left")
        .withColumns(
            {
                "all_cents": F.when(F.col("status") == "MATCH", F.lit(0)).otherwise(variance),
                "gap": F.when(both, -F.coalesce("gap_cents", F.lit(0))).otherwise(F.lit(0)),
                "rounding": F.when(both & whole, F.coalesce(of_bills, F.lit(0))).otherwise(F.lit(0)),
            }
        )
    )

    def money_of(part: Column, name: str) -> Column:
        return (part / F.lit(100.0)).alias(name)

    return cents.select(
        "month",
        "status",
        F.coalesce("lost_store_days", F.lit(0)).alias("lost_store_days"),
        money_of(F.col("all_cents"), "variance_inr"),
        money_of(F.col("gap"), "source_gap_inr"),
        money_of(F.col("rounding"), "rounding_inr"),
        money_of(F.col("all_cents") - F.col("gap") - F.col("rounding"), "scope_inr"),
    )
