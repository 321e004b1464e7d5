"""Retail queries over the driver tables, and the end-to-end retail job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from mercatura.functions.money import line_amount, total
from mercatura.operators import asof, dedup, digests, dims, marts, reconcile
from mercatura.session import new_table_path, share, stage, stage_once
from mercatura.sources import exports, files, ledger, sinks, standins

LAKE_MONTH = "1998-10"
AS_OF_BEFORE, AS_OF_AFTER = "1996-03-31", "1999-10-31"
PRICED_CODES = ["P3", "P17", "P40", "P41", "P99", "no such code"]
PART_STORE = "S04"

def fresh_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_latest(standins.raw_lines(spark, sf_dir))


def fresh_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_fact(lines(spark, sf_dir), standins.products(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines, stored by the first query that needs them."""
    return stage_once(spark, sf_dir, "lines", lambda: fresh_lines(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact, stored by the first query that needs it."""
    return stage_once(spark, sf_dir, "fact", lambda: fresh_fact(spark, sf_dir))


def fact_sales_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact with versions carried along sorted groups instead of joined on intervals."""
    return marts.sales_fact(lines(spark, sf_dir), standins.products(spark, sf_dir), asof.last_version)


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standins.table(spark, sf_dir, "orders")
    return dims.calendar(dims.year_bounds(orders, "o_orderdate"))


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the partitioned lake of these tables, written by the first query that needs it."""

    def build() -> str:
        root = new_table_path(spark, "lake")
        sinks.write_lake(dedup.with_month(lines(spark, sf_dir)), root)
        return root

    return share(spark, sf_dir, "lake", build)


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_lake(spark, lake_root(spark, sf_dir))


def ingest_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till lines written as daily and re-sent exports, and read back."""
    root = new_table_path(spark, "exports")
    standins.write_exports(standins.raw_lines(spark, sf_dir), root)
    return exports.read_exports(spark, root, standins.EXPORT_DIALECTS)


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).groupBy("store_id", "year_month").agg(
        F.count("*").alias("n_lines"),
        total(line_amount(F.col("qty"), F.col("unit_price"))).alias("amount"),
        F.min("business_date").alias("first_day"),
        F.max("business_date").alias("last_day"),
    )


def partition_pruning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_report(lake(spark, sf_dir), (F.col("store_id") == PART_STORE) & (F.col("year_month") == LAKE_MONTH))


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_month(fresh_lines(spark, sf_dir))


def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_profile(standins.raw_lines(spark, sf_dir))


def table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.table_checksum(lines(spark, sf_dir))


def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.tree(stage(digests.leaves(lake(spark, sf_dir)), "leaves"))


def _first_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the first exports, before any was sent again."""
    sent = standins.export_lines(standins.raw_lines(spark, sf_dir))
    first = sent.filter(~F.col("export").endswith("__R1")).drop("export")
    return dedup.with_month(dedup.keep_latest(first))


def load_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores and months that re-sent exports changed, found by digests, and how many lines in each."""
    before, after = stage(_first_sent(spark, sf_dir), "first_sent"), lake(spark, sf_dir)
    trees = [digests.tree(stage(digests.leaves(side), "leaves")) for side in (before, after)]
    partitions = stage(digests.differing(*trees), "differing")
    changed = digests.changed_lines(before, after, partitions).groupBy("store_id", "year_month").agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("lines_gained"),
        F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("lines_lost"),
    )
    return partitions.join(changed, ["store_id", "year_month"])


def idempotent_reload(spark: SparkSession, sf_dir: str, runs: int = 3) -> DataFrame:
    """Load the same lines several times into one table; each run reports what is then in it."""
    root = new_table_path(spark, "reload")
    reports = []
    for run in range(1, runs + 1):
        loaded = sinks.reload(dedup.with_month(fresh_lines(spark, sf_dir)), root)
        state = dedup.table_checksum(loaded).first()
        reports.append((run, state.row_count, state.checksum))
    return spark.createDataFrame(reports, "run int, row_count bigint, checksum string")


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of an export folder: daily files, then re-sent ones beside them, then nothing new.

    Each reports the files and lines it read, and what is then in the table.
    """
    folder, table, ledger_root = (new_table_path(spark, n) for n in ("exports", "ingested", "ledger"))
    sent = stage(standins.export_lines(standins.raw_lines(spark, sf_dir)), "sent")
    reports = []
    for resent in (False, True, None):
        if resent is not None:
            standins.write_exports(sent, folder, resent)
        read = ledger.load_new_files(spark, folder, table, ledger_root, standins.EXPORT_DIALECTS, ("year_month",))
        state = dedup.table_checksum(files.read_lake(spark, table)).first()
        held = {c: F.lit(state[c]) for c in ("row_count", "checksum")}
        reports.append(stage(read.withColumns(held), "report"))
    return reduce(DataFrame.unionByName, reports)


def rev_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_store(fact(spark, sf_dir), standins.stores(spark, sf_dir))


def rev_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_category(
        fact(spark, sf_dir), standins.products(spark, sf_dir), standins.categories(spark, sf_dir)
    )


def rev_by_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_weekday(fact(spark, sf_dir), dates(spark, sf_dir))


def rev_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_month(fact(spark, sf_dir), dates(spark, sf_dir))


def federated_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_store_categories(
        files.read_lake(spark, lake_root(spark, sf_dir), LAKE_MONTH),
        standins.stores(spark, sf_dir),
        standins.products(spark, sf_dir).filter("product_sk <> 0"),
        standins.categories(spark, sf_dir),
        LAKE_MONTH,
    )


def _prices(
    spark: SparkSession, sf_dir: str, as_of: str, codes: list[str] | None = None
) -> DataFrame:
    return asof.prices_as_of(
        standins.products(spark, sf_dir),
        standins.categories(spark, sf_dir),
        standins.prices(spark, sf_dir),
        as_of,
        codes,
    )


def _plain_prices(prices: DataFrame) -> DataFrame:
    return prices.withColumns({c: F.col(c).cast("double") for c in ("price", "list_price")})


def prices_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_prices(_prices(spark, sf_dir, AS_OF_BEFORE))


def prices_of_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_prices(_prices(spark, sf_dir, AS_OF_AFTER, PRICED_CODES))


def price_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.price_drift(
        _prices(spark, sf_dir, AS_OF_BEFORE), _prices(spark, sf_dir, AS_OF_AFTER)
    )


def _reconciled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    everything = lines(spark, sf_dir)
    products = standins.products(spark, sf_dir)
    feed = standins.without_outage(everything)
    feed_fact = marts.sales_fact(feed, products)
    signed = standins.finance(marts.sales_fact(everything, products))
    return reconcile.reconcile(reconcile.monthly_revenue(feed_fact), signed), feed_fact, feed


def finance_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)[0]


def variance_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    reconciled, feed_fact, feed = _reconciled(spark, sf_dir)
    return reconcile.classify_variance(
        reconciled,
        marts.bill_rounded_revenue(feed_fact),
        reconcile.missing_days(feed),
    )


def variance_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variance by cause, where one month of the outage is rounded too."""
    everything, products = lines(spark, sf_dir), standins.products(spark, sf_dir)
    feed = standins.without_outage(everything)
    feed_fact = marts.sales_fact(feed, products)
    rounded = (standins.ROUNDED_MONTH, standins.ROUNDED_OUTAGE_MONTH)
    signed = standins.finance(marts.sales_fact(everything, products), rounded)
    missing = stage(reconcile.missing_days(feed), "missing_days")
    return reconcile.variance_parts(
        reconcile.reconcile(reconcile.monthly_revenue(feed_fact), signed),
        marts.bill_rounded_revenue(feed_fact),
        missing,
        reconcile.weekday_profile(feed, feed_fact, missing),
    )


def missing_store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = standins.without_outage(lines(spark, sf_dir))
    return reconcile.missing_days(feed)


def rev_bill_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.bill_rounded_revenue(fact(spark, sf_dir))


def line_type_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.line_type_breakdown(
        lines(spark, sf_dir), line_amount(F.col("qty"), F.col("unit_price"))
    )


def reissued_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.reissued_codes(standins.products(spark, sf_dir))


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Settled order lines, one of each key, and a later batch of open ones as sent, keys repeated in it."""
    raw = standins.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("bill_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").cast("date").cast("string").alias("raw_ts"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code"),
        F.col("l_quantity").alias("qty"),
        "l_linestatus",
    )
    return dedup.keep_latest(raw.filter("l_linestatus = 'F'")), raw.filter("l_linestatus = 'O'")


def upsert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.upsert_keep_first(*_two_loads(spark, sf_dir), ["bill_no", "line_no"], ["raw_ts"])


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.upsert_keep_last(*_two_loads(spark, sf_dir), ["bill_no", "line_no"], ["raw_ts"])


QUERIES = {
    "ingest_dialects": ingest_dialects,
    "lake_roundtrip": lake_roundtrip,
    "partition_pruning_report": partition_pruning_report,
    "dedup_latest": dedup_latest,
    "dedup_stats": dedup_stats,
    "table_checksum": table_checksum,
    "digest_tree": digest_tree,
    "load_difference": load_difference,
    "idempotent_reload": idempotent_reload,
    "ingest_ledger": ingest_ledger,
    "upsert_ignore": upsert_ignore,
    "upsert_replace": upsert_replace,
    "dim_store": standins.stores,
    "dim_category": standins.categories,
    "dim_product": standins.products,
    "dim_date": dates,
    "reissued_codes": reissued_codes,
    "fact_sales": fresh_fact,
    "fact_sales_sorted": fact_sales_sorted,
    "line_type_breakdown": line_type_breakdown,
    "rev_by_store": rev_by_store,
    "rev_by_category": rev_by_category,
    "rev_by_dow": rev_by_dow,
    "rev_by_month": rev_by_month,
    "rev_bill_rounded": rev_bill_rounded,
    "federated_topn": federated_topn,
    "prices_as_of": prices_as_of,
    "prices_of_codes": prices_of_codes,
    "price_drift": price_drift,
    "finance_reconcile": finance_reconcile,
    "variance_class": variance_class,
    "variance_money": variance_money,
    "missing_store_days": missing_store_days,
}


def run(
    spark: SparkSession,
    raw: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    signed: DataFrame,
    root: str,
) -> dict[str, DataFrame]:
    """The whole retail job: land the lake, build the fact once, slice it and reconcile it.

    Every later step reads the written fact, so lines are deduplicated and joined a single time.
    """
    sinks.write_lake(dedup.with_month(dedup.keep_latest(raw)), f"{root}/lake")
    lake = files.read_lake(spark, f"{root}/lake")
    built = sinks.reload(marts.sales_fact(lake, products), f"{root}/fact")
    calendar = dims.calendar(dims.year_bounds(built, "date_key"))
    monthly = reconcile.monthly_revenue(built)
    reconciled = reconcile.reconcile(monthly, signed)
    return {
        "rev_by_store": marts.revenue_by_store(built, stores),
        "rev_by_category": marts.revenue_by_category(built, products, categories),
        "rev_by_dow": marts.revenue_by_weekday(built, calendar),
        "rev_by_month": marts.revenue_by_month(built, calendar),
        "federated_topn": marts.top_store_categories(
            files.read_lake(spark, f"{root}/lake", LAKE_MONTH),
            stores,
            products.filter("product_sk <> 0"),
            categories,
            LAKE_MONTH,
        ),
        "finance_reconcile": reconciled,
        "variance_class": reconcile.classify_variance(
            reconciled,
            marts.bill_rounded_revenue(built),
            reconcile.missing_days(lake),
        ),
    }
