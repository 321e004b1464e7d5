"""The driver tables reshaped as till lines, master data, signed-off figures, notices and labels."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mercatura.functions import sets, text as tx
from mercatura.functions.money import money
from mercatura.operators import dims
from mercatura.operators.joins import join_by_key
from mercatura.operators.shingles import spread
from mercatura.schemas import FINANCE_MONTH
from mercatura.sources.exports import Dialect, RENAMED_COLUMNS, STAGED_COLUMNS

REISSUE_DAY = "1998-04-01"
MASTER_START = "1990-01-01"
# Invented anomalies: a store without exports for some weeks, a sale made elsewhere, a rounded month.
OUTAGE_STORE, OUTAGE_FIRST, OUTAGE_LAST = "S13", "1995-02-11", "1995-05-20"
SCOPE_MONTH, SCOPE_AMOUNT = "1994-11", 73918.40
ROUNDED_MONTH = "1997-09"
# A month of the outage, rounded as well where causes are told apart in money.
ROUNDED_OUTAGE_MONTH = "1995-03"
# First and last day of each price interval, and its price and list price in per cent of the base price.
PRICE_INTERVALS = (
    (MASTER_START, "1996-12-31", 100, 112),
    ("1997-01-01", "1999-06-30", 105, 118),
    ("1999-07-01", "9999-12-31", 112, 125),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _store_id(nation_key: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(nation_key.cast("string"), 2, "0"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged lines: each order line with its tax line, and one tender line per order.

    The tables hold repeated (order, line) keys, which play the re-sent lines. Prices are computed in
    whole cents, so any engine gets the same doubles. Lines come out partitioned by bill, so what groups or
    deduplicates them by bill and line shuffles order lines only, before they become several wide lines each.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bills = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("bill_no"),
            "o_totalprice",
            _store_id(F.col("c_nationkey")).alias("store_id"),
            F.col("o_orderdate").cast("date").alias("business_date"),
        )
        .repartition(tasks, "bill_no")
    )
    flags = F.concat("l_returnflag", "l_linestatus")
    qty, cents = F.col("l_quantity").cast("bigint"), _cents(F.col("l_extendedprice"))
    unit_cents = F.expr("(2 * cents + qty) div (2 * qty)")
    percent = F.expr("(cents * rate + 50) div 100")
    sold = (
        table(spark, sf_dir, "lineitem")
        .withColumn("bill_no", F.col("l_orderkey").cast("string"))
        .repartition(tasks, "bill_no")
        .join(bills, "bill_no")
        .withColumns({"flags": flags, "qty": qty, "cents": cents})
        .withColumn("rate", _cents(F.col("l_discount")))
        .withColumns({"unit_cents": unit_cents, "off_cents": percent})
        .withColumn("rate", _cents(F.col("l_tax")))
        .withColumn("tax_cents", percent)
    )
    discount, negative = F.col("flags") == "AF", F.col("flags").isin("RF", "RO")
    product = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    goods = F.struct(
        F.col("l_linenumber").cast("int").alias("line_no"),
        F.when(discount, F.lit("DISC")).otherwise(product).alias("product_code"),
        F.when(discount, F.lit(1.0))
        .otherwise(F.when(negative, -F.col("l_quantity")).otherwise(F.col("l_quantity")))
        .alias("qty"),
        (F.when(discount, -F.col("off_cents")).otherwise(F.col("unit_cents")) / F.lit(100.0)).alias(
            "unit_price"
        ),
        F.when(discount, "DISCOUNT")
        .when(F.col("flags") == "RF", "RETURN")
        .when(F.col("flags") == "RO", "VOID")
        .otherwise("SALE")
        .alias("line_type"),
    )
    tax = F.struct(
        (F.col("l_linenumber") + 1000).cast("int").alias("line_no"),
        F.lit("TAX").alias("product_code"),
        F.lit(1.0).alias("qty"),
        (F.col("tax_cents") / F.lit(100.0)).alias("unit_price"),
        F.lit("TAX").alias("line_type"),
    )
    lines = sold.select(
        "bill_no",
        F.col("l_shipdate").cast("date").cast("string").alias("raw_ts"),
        "store_id",
        "business_date",
        F.inline(F.array(goods, tax)),
    )
    shape = [
        "bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "raw_ts",
        "store_id", "business_date",
    ]
    tenders = bills.select(
        "bill_no",
        F.lit(9000).alias("line_no"),
        F.lit("TENDER").alias("product_code"),
        F.lit(1.0).alias("qty"),
        F.col("o_totalprice").alias("unit_price"),
        F.lit("TENDER").alias("line_type"),
        F.col("business_date").cast("string").alias("raw_ts"),
        "store_id",
        "business_date",
    )
    return lines.select(*shape).unionByName(tenders.select(*shape))


def without_outage(lines: DataFrame) -> DataFrame:
    """The feed as exported: one store lost its exports for some weeks."""
    lost = F.col("business_date").between(F.lit(OUTAGE_FIRST).cast("date"), F.lit(OUTAGE_LAST).cast("date"))
    return lines.filter(~((F.col("store_id") == OUTAGE_STORE) & lost))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _store_id(F.col("n_nationkey")).alias("store_id"),
        F.concat(F.lit("Store "), "n_name").alias("store_name"),
        F.concat(F.lit("Main Street "), F.col("n_nationkey").cast("string")).alias("address_line"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("r_name").alias("region"),
        (1000 + 100 * F.col("n_nationkey")).cast("int").alias("floor_area_sqft"),
        F.to_date(F.lit(MASTER_START)).alias("opened_on"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select("p_type").distinct()
    fresh = F.col("p_type").isin("PROMO", "SMALL")
    return dims.with_discount_category(
        kinds.select(
            F.concat(F.lit("C-"), "p_type").alias("category_id"),
            F.initcap("p_type").alias("category_name"),
            F.when(fresh, "Fresh").otherwise("Food").alias("department"),
            F.when(fresh, F.lit(0.05)).otherwise(F.lit(0.18)).alias("gst_rate"),
        )
    )


def _is_reissued() -> Column:
    return F.col("p_size") > 48


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned products: codes of the two largest sizes were reissued to another product."""
    version = F.struct
    first = version(
        (2 * F.col("p_partkey") + 1).alias("product_sk"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("C-"), "p_type").alias("category_id"),
        F.to_date(F.lit(MASTER_START)).alias("valid_from"),
        F.when(_is_reissued(), F.date_sub(F.to_date(F.lit(REISSUE_DAY)), 1))
        .otherwise(F.lit(dims.OPEN_END))
        .alias("valid_to"),
        (~_is_reissued()).alias("is_current"),
    )
    second = version(
        (2 * F.col("p_partkey") + 2).alias("product_sk"),
        F.concat(F.lit("reissued "), "p_name").alias("product_name"),
        F.lit("C-PROMO").alias("category_id"),
        F.to_date(F.lit(REISSUE_DAY)).alias("valid_from"),
        F.lit(dims.OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    versions = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("pack_size"),
        F.lit("EA").alias("uom"),
        F.inline(F.when(_is_reissued(), F.array(first, second)).otherwise(F.array(first))),
    )
    return dims.with_discount_product(
        versions.select(
            "product_sk", "product_code", "product_name", "category_id", "brand", "pack_size",
            "uom", "valid_from", "valid_to", "is_current",
        )
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three closed price intervals for each product version."""
    base = F.expr("cast(round(p_retailprice * 100) as bigint) + if(is_second, 500, 0)")

    def part_of_base(percent: int) -> Column:
        return money(F.expr(f"(cents * {percent} + 50) div 100") / F.lit(100).cast("decimal(5,0)"))

    intervals = F.array(
        *[
            F.struct(
                part_of_base(sell).alias("selling_price"),
                part_of_base(mrp).alias("mrp"),
                F.to_date(F.lit(start)).alias("effective_from"),
                F.to_date(F.lit(end)).alias("effective_to"),
            )
            for start, end, sell, mrp in PRICE_INTERVALS
        ]
    )
    versions = F.when(_is_reissued(), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", "p_retailprice", F.explode(versions).alias("is_second"))
        .withColumn("cents", base)
        .select(
            F.expr("2 * p_partkey + if(is_second, 2, 1)").alias("product_sk"), F.inline(intervals)
        )
    )


def finance(full_fact: DataFrame, rounded=(ROUNDED_MONTH,)) -> DataFrame:
    """Signed-off months: complete revenue, one month with a sale made outside the tills, ``rounded`` ones."""
    from mercatura.operators.marts import bill_rounded_revenue

    months = bill_rounded_revenue(full_fact)
    signed = (
        F.when(F.col("month") == SCOPE_MONTH, F.col("line_revenue") + F.lit(SCOPE_AMOUNT))
        .when(F.col("month").isin(*rounded), F.col("bill_rounded_revenue"))
        .otherwise(F.col("line_revenue"))
    )
    return months.select(
        "month", money(signed).cast(FINANCE_MONTH["revenue_inr"].dataType).alias("revenue_inr")
    )


# --- till exports, written so that they can be read back -----------------------------------------

EXPORT_DIALECTS = (
    Dialect("*SALES_S0[0-5]_*"),
    Dialect("*SALES_S0[6-9]_*", ";", RENAMED_COLUMNS),
    Dialect("*SALES_S[12]*_*"),
)


def export_lines(lines: DataFrame) -> DataFrame:
    """Lines with the name of their export: one a store and day, and a re-sent one for later copies of a line.

    Lines that are partitioned by bill are not shuffled. Those without a bill or line number are in no export.
    """
    key = ["bill_no", "line_no"]
    first_ts = F.min("raw_ts").over(Window.partitionBy(*key))
    name = F.concat(
        F.lit("SALES_"), "store_id", F.lit("_"), F.date_format("business_date", "yyyyMMdd"),
        F.when(F.col("raw_ts") > F.col("first_ts"), F.lit("__R1")).otherwise(F.lit("")),
    )
    return lines.dropna(subset=key).withColumn("first_ts", first_ts).withColumn("export", name).drop("first_ts")


def export_files(lines: DataFrame) -> DataFrame:
    """The text of each export: ``export, content``. ``lines`` may have the names of ``export_lines`` already.

    Rows are partitioned by export before they are gathered, so the texts are not shuffled.
    """
    # a fixed number: adaptive execution would have one task write the many small files of a small table
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.substring("store_id", 2, 2).cast("int")
    member = (number <= 5, (number >= 6) & (number <= 9), number >= 10)
    named = lines if "export" in lines.columns else export_lines(lines)

    pairs = list(zip(EXPORT_DIALECTS, member))
    dialect = F.coalesce(*(F.when(belongs, F.lit(k)) for k, belongs in enumerate(member)))
    header = F.coalesce(*(F.when(F.col("dialect") == k, d.separator.join(d.columns)) for k, d in enumerate(EXPORT_DIALECTS)))
    row = F.coalesce(
        *(F.when(belongs, F.to_csv(F.struct(*STAGED_COLUMNS), {"sep": d.separator})) for d, belongs in pairs)
    )
    written = named.select("export", dialect.alias("dialect"), row.alias("row"))
    return written.repartition(tasks, "export").groupBy("export", "dialect").agg(F.collect_list("row").alias("rows")).select(
        "export", F.concat_ws("\n", header, F.array_join("rows", "\n"), F.lit("")).alias("content")
    )


def write_exports(lines: DataFrame, root: str, resent: bool | None = None) -> None:
    """One file for each export, written by the tasks under a temporary name and then renamed.

    With ``resent`` given, only the re-sent files or only the others.
    """
    uri = re.sub("^file:/+", "/", root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(uri)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for export, content in zip(batch["export"].to_pylist(), batch["content"].to_pylist(), strict=True):
                hidden = f"{folder}/.{export}.{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as file:
                    file.write(content.encode())
                system.move(hidden, f"{folder}/{export}.csv")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    files = export_files(lines)
    if resent is not None:
        files = files.filter(F.col("export").endswith("__R1") == resent)
    files.mapInArrow(write, "n long").agg(F.sum("n")).collect()


# --- notices -----------------------------------------------------------------------------------

NOTICE_RULES = (
    tx.BoilerplateRule(("src1", "src2", "src5"), "Licensed under the", "All rights reserved."),
    tx.BoilerplateRule(("src3", "src4", "src6"), "Released under the"),
)


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("notice_id"),
        F.col("source").alias("portal_id"),
        "lang",
        F.col("text").alias("body"),
    )


def cleaned_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = tx.clean_text(F.col("body"), F.col("portal_id"), NOTICE_RULES)
    return spread(notices(spark, sf_dir), "notice_id").select("notice_id", "portal_id", clean.alias("clean"))


SAME_LABEL = 0.8


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs to judge: each notice with the first notice of its block, labelled on raw text.

    Blocks are the longest word of the notice, and its source and language. Every notice joins only the
    first of its block, so the pairs grow with the notices whatever the block sizes. The label compares
    raw character runs, which retrieval does not use. The first of a block is in many pairs: its text travels by
    tile of pairs, not by pair.
    """
    folded = tx.squeeze(tx.fold_ascii(F.col("body")))
    longest = F.array_max(
        F.transform(
            F.split(folded, " "), lambda w: F.concat(F.lpad(F.length(w).cast("string"), 6, "0"), w)
        )
    )
    base = notices(spark, sf_dir)
    from mercatura.operators.resolve import score_pairs
    from mercatura.session import stage

    words = spread(base, "notice_id").select(
        "notice_id",
        F.explode(
            F.array(F.concat(F.lit("w:"), longest), F.concat_ws(":", F.lit("s"), "portal_id", "lang"))
        ).alias("block"),
    )
    blocked = stage(words, "blocked")
    firsts = blocked.groupBy("block").agg(F.min("notice_id").alias("notice_id_a"))
    pairs = (
        join_by_key(blocked, firsts, ["block"])
        .filter("notice_id_a <> notice_id")
        .select("notice_id_a", F.col("notice_id").alias("notice_id_b"))
        .distinct()
    )
    texts = base.select(F.col("notice_id").alias("doc"), tx.flat_text(F.col("body")).alias("clean"))
    same = F.col("raw_jaccard") >= SAME_LABEL
    return (
        score_pairs(pairs.toDF("doc_a", "doc_b"), texts, partial(sets.keyed_kgram_jaccard, k=5, keep_short=True))
        .toDF("notice_id_a", "notice_id_b", "raw_jaccard")
        .withColumn("label", F.when(same, "same").otherwise("different"))
    )
