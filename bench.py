"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from mercatura.functions import text  # noqa: E402
from mercatura.operators import (  # noqa: E402
    dedup, lsh, marts, reconcile, resolve as rs, shingles as sh,
)
from mercatura.plans import retail  # noqa: E402
from mercatura.session import build_session, new_table_path, release, stage  # noqa: E402
from mercatura.sources import files, sinks, standins  # noqa: E402

CPUS = os.environ.get("BENCH_CPUS", "8")
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = "/root/testdata/sf0.001"

# Small inputs that cost much more to process than to read: cut them finer than a cluster would.
LOCAL = {
    "spark.driver.memory": "16g",
    "spark.sql.shuffle.partitions": CPUS,
    "spark.sql.files.maxPartitionBytes": "2m",
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def retail_steps(spark, sf_dir: str):
    """The retail job cut where the published figures cut it; lines and fact are stored once."""
    state = {}

    def stage_lines():
        state["raw"] = stage(standins.raw_lines(spark, sf_dir), "raw")

    def dedup_load():
        dedup.table_checksum(dedup.keep_latest(state["raw"])).collect()

    def lake_write():
        state["root"] = new_table_path(spark, "lake")
        lines = dedup.keep_latest(state["raw"])
        sinks.write_lake(dedup.with_month(lines), state["root"])

    def fact_build():
        lines = dedup.keep_latest(state["raw"])
        state["fact"] = stage(marts.sales_fact(lines, standins.products(spark, sf_dir)), "fact")

    def rev_by_store():
        consume(marts.revenue_by_store(state["fact"], standins.stores(spark, sf_dir)))

    def rev_by_category():
        consume(
            marts.revenue_by_category(
                state["fact"], standins.products(spark, sf_dir), standins.categories(spark, sf_dir)
            )
        )

    def rev_by_dow():
        consume(marts.revenue_by_weekday(state["fact"], retail.dates(spark, sf_dir)))

    def rev_by_month():
        consume(marts.revenue_by_month(state["fact"], retail.dates(spark, sf_dir)))

    def federated_topn():
        consume(
            marts.top_store_categories(
                files.read_lake(spark, state["root"], retail.LAKE_MONTH),
                standins.stores(spark, sf_dir),
                standins.products(spark, sf_dir).filter("product_sk <> 0"),
                standins.categories(spark, sf_dir),
                retail.LAKE_MONTH,
            )
        )

    def price_drift():
        consume(retail.price_drift(spark, sf_dir))

    def finance_reconcile():
        signed = standins.finance(state["fact"])
        consume(reconcile.reconcile(reconcile.monthly_revenue(state["fact"]), signed))

    return (
        stage_lines, dedup_load, lake_write, fact_build, rev_by_store, rev_by_category, rev_by_dow,
        rev_by_month, federated_topn, price_drift, finance_reconcile,
    )


def notice_steps(spark, sf_dir: str):
    """The notice job cut where the published figures cut it."""
    state = {}

    def load_notices():
        state["notices"] = stage(standins.notices(spark, sf_dir).repartition(2 * int(CPUS)), "notices")

    def shingles_and_pruning():
        clean = text.clean_text(F.col("body"), F.col("portal_id"), standins.NOTICE_RULES)
        cleaned = state["notices"].select("notice_id", "portal_id", clean.alias("clean"))
        state["cleaned"] = stage(cleaned, "cleaned")
        state["documents"] = stage(sh.distinct_documents(state["cleaned"]), "documents")
        state["rows"] = sh.shingle_rows(state["documents"])
        state["frequency"] = stage(sh.document_frequency(state["rows"]), "frequency")
        state["stop"] = stage(sh.stop_shingles(state["frequency"], state["cleaned"]), "stop")

    def signatures_and_buckets():
        kept = sh.prune(state["rows"], state["stop"])
        state["bands"] = stage(lsh.band_rows(lsh.signature_parts(kept)), "bands")

    def candidate_retrieval():
        pairs = lsh.candidate_pairs(state["bands"], state["documents"], state["frequency"])
        state["pairs"] = stage(pairs, "pairs")

    def verification():
        state["verified"] = stage(rs.verify(state["pairs"], state["documents"]), "verified")

    def clustering():
        found = rs.connected_components(state["verified"].select("doc_a", "doc_b"))
        members = found.toDF("doc", "component")
        consume(rs.cluster_members(state["cleaned"], state["documents"], members))

    def index_build():
        state["index"] = f"buckets_{uuid.uuid4().hex}"
        lsh.store_index(state["bands"], state["documents"], state["frequency"], state["index"], 2 * int(CPUS))

    def bucket_lookup():
        """All labelled documents looked up, from their own texts and the stored index."""
        batch = state["documents"].join(
            standins.table(spark, sf_dir, "labels"), F.col("doc") == F.col("doc_id"), "left_semi"
        )
        batch = stage(batch, "batch")
        kept = sh.prune(sh.shingle_rows(batch), state["stop"])
        keys = stage(lsh.band_rows(lsh.signature_parts(kept)), "keys")
        prefixes = stage(lsh.rare_prefixes(batch, state["frequency"]), "batch_prefixes")
        consume(lsh.indexed_lookup(keys, prefixes, state["index"]))

    def notice_job():
        """From raw notices: loading and cleaning included."""
        consume(rs.resolve(standins.cleaned_notices(spark, sf_dir)))

    return (
        load_notices, shingles_and_pruning, signatures_and_buckets, candidate_retrieval, verification,
        clustering, index_build, bucket_lookup, notice_job,
    )


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **LOCAL)
    spark.sparkContext.setLogLevel("ERROR")
    for step in (*retail_steps(spark, WARM_DIR), *notice_steps(spark, WARM_DIR)):
        step()
    times = {}
    for step in (*retail_steps(spark, SF_DIR), *notice_steps(spark, SF_DIR)):
        times[step.__name__] = timed(step)
    lines = standins.raw_lines(spark, SF_DIR).count()
    documents = standins.notices(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "raw_lines": lines,
                "notices": documents,
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
