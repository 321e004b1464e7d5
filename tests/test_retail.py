import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mercatura.functions.money import line_amount
from mercatura.operators import asof, dedup, digests, dims, marts, reconcile
from mercatura.schemas import CATEGORY, PRODUCT, STAGED_LINE
from mercatura.session import stage
from mercatura.sources import exports, files, ledger, sinks, standins

DAY = dt.date(2024, 3, 5)
END = dims.OPEN_END


def line(bill="B1", no=1, code="P1", qty=1.0, price=10.0, kind="SALE", ts="10:00", store="S01", day=DAY):
    return (bill, no, code, qty, price, kind, ts, store, day)


def product(sk, code, start, end, category="C01"):
    return (sk, code, f"name {sk}", category, "brand", "1", "EA", start, end, end == END)


@pytest.fixture
def staged(spark):
    return lambda *lines: spark.createDataFrame(list(lines), STAGED_LINE)


@pytest.fixture
def products(spark):
    return lambda *items: spark.createDataFrame(list(items), PRODUCT)


def test_keep_latest_takes_latest_and_breaks_ties_the_same_way(staged, rows):
    a, b, c = line(price=1.0), line(price=2.0), line(price=9.0, ts="09:00")
    first = rows(dedup.keep_latest(staged(a, b, c)), "unit_price")
    second = rows(dedup.keep_latest(staged(c, b, a)), "unit_price")
    assert first == second == [(2.0,)]


def test_keep_latest_limits_each_task_before_the_shuffle(staged):
    plan = dedup.keep_latest(staged(line()))._jdf.queryExecution().executedPlan().toString()
    partial = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in plan.split("Exchange")[0] and "WindowGroupLimit" in partial


def test_duplicate_profile(staged, rows):
    profile = dedup.duplicate_profile(staged(line(), line(), line(), line(no=2)))
    assert rows(profile) == [(4, 2, 2, 3)]


def test_checksum_ignores_order_and_partitions_but_not_content(staged, rows):
    lines = [line(no=i, price=i / 7) for i in range(50)]
    one = rows(dedup.table_checksum(staged(*lines).coalesce(1)))
    other = rows(dedup.table_checksum(staged(*reversed(lines)).repartition(7)))
    changed = rows(dedup.table_checksum(staged(line(no=0, price=5.0), *lines[1:])))
    repeated = rows(dedup.table_checksum(staged(*lines, lines[0], lines[0])))
    assert one == other
    assert len({x[0] for x in (one[0], changed[0], repeated[0])}) == 2
    assert len({x[1] for x in (one[0], changed[0], repeated[0])}) == 3


def test_digest_tree_locates_changed_lines(staged, rows):
    may = dt.date(2024, 5, 1)
    lines = [line(f"B{k}", store=f"S0{k % 3}", day=(DAY, may)[k % 2]) for k in range(24)]
    later = [*lines[1:], line("B0", price=11.0, store="S00"), line("B99", store="S07"), lines[5]]
    sides = [dedup.with_month(staged(*x)) for x in (lines, [l for l in later if l[0] != "B3"])]
    before, after = (digests.tree(digests.leaves(side)) for side in sides)
    assert rows(before.groupBy("level").agg(F.sum("row_count"), F.sum("n_children"))) == [
        ("month", 24, 0), ("root", 24, 3), ("store", 24, 6)
    ]
    partitions = digests.differing(before, after)
    assert rows(partitions) == [
        ("S00", "2024-03", 4, 4), ("S00", "2024-05", 4, 3), ("S02", "2024-05", 4, 5), ("S07", "2024-03", 0, 1)
    ]
    changed = digests.changed_lines(*sides, partitions)
    assert rows(changed, "bill_no", "surplus") == [("B0", -1), ("B0", 1), ("B3", -1), ("B5", 1), ("B99", 1)]


def test_digest_trees_of_equal_and_empty_tables(staged, rows):
    lines = [line(f"B{k}", k, price=k / 7, store=f"S0{k % 3}") for k in range(20)]
    one, other, none = (
        digests.tree(digests.leaves(dedup.with_month(x)))
        for x in (staged(*lines), staged(*reversed(lines)).repartition(5), staged(line()).limit(0))
    )
    assert rows(one) == rows(other) and rows(digests.differing(one, other)) == []
    assert rows(none, "level", "n_children", "row_count") == [("root", 0, 0)]
    assert rows(digests.differing(none, one), "rows_before", "rows_after") == [(0, 6), (0, 7), (0, 7)]


def test_line_amount_is_rounded_half_up(spark, rows):
    data = spark.createDataFrame([(0.5, 0.01), (-0.5, 0.01), (1.005, 1.0), (3.0, 19.99)], "q double, p double")
    got = [float(r[0]) for r in data.select(line_amount(F.col("q"), F.col("p"))).collect()]
    assert got == [0.01, -0.01, 1.01, 59.97]


def test_point_in_time_join_includes_both_ends_and_keeps_unmatched(staged, products, rows):
    split = dt.date(2024, 6, 1)
    dim = products(
        product(1, "P1", dt.date(2024, 1, 1), split - dt.timedelta(1)),
        product(2, "P1", split, END),
    )
    lines = staged(
        line("A", day=dt.date(2024, 1, 1)),
        line("B", day=split - dt.timedelta(1)),
        line("C", day=split),
        line("D", day=dt.date(2023, 12, 31)),
        line("E", code="P9"),
        line("F", kind="TENDER"),
        line("G", kind="TAX"),
    )
    fact = marts.sales_fact(lines, dim)
    assert rows(fact, "bill_no", "product_sk") == [("A", 1), ("B", 1), ("C", 2), ("D", 0), ("E", 0)]


def test_last_version_equals_the_join_and_spreads_a_hot_code(staged, products, rows):
    split = dt.date(2024, 6, 1)
    dim = products(
        product(1, "P1", dt.date(2024, 1, 1), split - dt.timedelta(1)),
        product(2, "P1", split + dt.timedelta(9), END),
        product(3, "P2", dt.date(2024, 3, 1), END),
        product(4, "P3", dt.date(2024, 3, 1), dt.date(2024, 3, 1)),
    )
    days = [dt.date(2023, 12, 30) + dt.timedelta(k) for k in range(200)]
    lines = staged(
        *(line(f"{code}-{k}", code=code, day=day) for code in ("P1", "P2", "P3", "P9") for k, day in enumerate(days)),
        line("none", code=None), line("never", day=None), line("P1-3", day=days[3]), line("P1-3", day=days[3]),
    )
    versions = dim.select("product_code", "product_sk", "valid_from", "valid_to")
    for rows_a_group in (1_000_000, 30):
        found = asof.last_version(lines, versions, "product_code", "business_date", group_rows=rows_a_group)
        joined = asof.join_version(lines, versions, "product_code", "business_date")
        assert found.columns == joined.columns and rows(found) == rows(joined)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any("Join" in step and "valid_from" in step for step in plan.splitlines())
    assert rows(asof.last_version(lines.limit(0), versions, "product_code", "business_date")) == []
    none = asof.last_version(lines, versions.limit(0), "product_code", "business_date")
    assert none.count() == lines.count() and none.filter("product_sk IS NOT NULL").isEmpty()


def test_overlapping_versions_fan_out_and_are_reported(staged, products, rows):
    dim = products(
        product(1, "P1", dt.date(2024, 1, 1), END), product(2, "P1", dt.date(2024, 2, 1), END)
    )
    assert marts.sales_fact(staged(line()), dim).count() == 2
    assert rows(dims.overlapping_versions(dim), "product_sk") == [(2,)]
    assert rows(dims.reissued_codes(dim)) == [("P1", 2)]


def test_slices_add_up_and_keep_discounts(spark, staged, products, rows):
    categories = dims.with_discount_category(
        spark.createDataFrame([("C01", "Biscuits", "Food", 0.18)], CATEGORY)
    )
    dim = dims.with_discount_product(products(product(1, "P1", dt.date(2020, 1, 1), END)))
    lines = staged(
        line("A", 1, qty=3.0), line("A", 2, "DISC", 1.0, -5.0, "DISCOUNT"),
        line("B", 1, qty=-1.0, kind="RETURN", store="S02", day=dt.date(2024, 4, 7)),
        line("A", 9, "TENDER", 1.0, 25.0, "TENDER"),
    )
    fact = marts.sales_fact(lines, dim)
    calendar = dims.calendar(dims.year_bounds(fact, "date_key"))
    by_category = marts.revenue_by_category(fact, dim, categories)
    assert rows(by_category, "category_name", "net_revenue", "total_units_sold") == [
        ("Bill Discounts", -5.0, 1), ("Biscuits", 20.0, 2),
    ]
    assert [tuple(r) for r in marts.revenue_by_weekday(fact, calendar).collect()] == [
        ("Sunday", -10.0, 1), ("Tuesday", 25.0, 1),
    ]
    assert rows(marts.revenue_by_month(fact, calendar)) == [
        ("2024-03", "March", 25.0), ("2024-04", "April", -10.0),
    ]
    stores = spark.createDataFrame(
        [("S01", "One", "X"), ("S02", "Two", "Y")], "store_id string, store_name string, city string"
    )
    assert rows(marts.revenue_by_store(fact, stores, 1), "store_id", "net_revenue", "total_bills") == [
        ("S01", 25.0, 1)
    ]
    lake = dedup.with_month(lines)
    top = marts.top_store_categories(
        lake, stores, dim.filter("product_sk <> 0"), categories, "2024-03"
    )
    assert rows(top, "store_name", "category_name", "revenue", "bill_count") == [
        ("One", "Biscuits", 30.0, 1)
    ]


def test_calendar_of_a_leap_year(spark, rows):
    bounds = spark.sql("SELECT date'2024-01-01' AS first_day, date'2024-12-31' AS last_day")
    days = dims.calendar(bounds)
    assert days.count() == 366
    assert rows(days.filter("full_date = '2024-03-03'").drop("date_key")) == [
        ("2024-03-03", 0, "Sunday", 3, 3, "March", "2024-03", 2024, True)
    ]


def test_prices_as_of_two_dates_and_drift(spark, products, rows):
    categories = spark.createDataFrame([("C01", "Biscuits", "Food", 0.18)], CATEGORY)
    dim = products(
        product(1, "PA", dt.date(2020, 1, 1), END), product(2, "PB", dt.date(2020, 1, 1), END),
        product(3, "PC", dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
    )
    prices = spark.createDataFrame(
        [
            (1, 10.0, 12.0, dt.date(2020, 1, 1), dt.date(2021, 5, 4)),
            (1, 12.5, 15.0, dt.date(2021, 5, 5), END),
            (2, 40.0, 44.0, dt.date(2020, 1, 1), dt.date(2021, 7, 7)),
            (2, 41.0, 45.0, dt.date(2021, 7, 8), END),
            (3, 9.0, 9.0, dt.date(2020, 1, 1), END),
        ],
        "product_sk long, selling_price double, mrp double, effective_from date, effective_to date",
    )
    before = asof.prices_as_of(dim, categories, prices, "2021-01-31")
    after = asof.prices_as_of(dim, categories, prices, "2021-12-31")
    assert rows(asof.price_drift(before, after), "product_code", "drift", "drift_pct") == [
        ("PA", 2.5, 25.0), ("PB", 1.0, 2.5),
    ]
    one = asof.prices_as_of(dim, categories, prices, "2021-05-05", ["PA", "PC", "none"])
    assert rows(one, "product_code", "price") == [("PA", 12.5)]


def test_reconciliation_classifies_injected_anomalies(spark, staged, products, rows):
    """Scope, outage and rounding months, and one that agrees; one store lost three days."""
    dim = products(product(1, "P1", dt.date(2020, 1, 1), END))
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(121)]
    lost = [dt.date(2024, 2, d) for d in (9, 10, 11)]
    lines = [
        line(f"{store}{day}", price=10.4, store=store, day=day)
        for day in days
        for store in ("S01", "S02")
        if not (store == "S02" and day in lost)
    ]
    feed = staged(*lines)
    fact = marts.sales_fact(feed, dim)
    signed = spark.createDataFrame(
        [("2024-01", 644.8), ("2024-02", 603.2), ("2024-03", 620.0), ("2024-04", 999.0), ("2024-05", 1.0)],
        "month string, revenue_inr double",
    )
    monthly = reconcile.monthly_revenue(fact)
    result = reconcile.classify_variance(
        reconcile.reconcile(monthly, signed),
        marts.bill_rounded_revenue(fact),
        reconcile.missing_days(feed),
    )
    assert rows(result, "month", "variance_inr", "status", "lost_store_days", "cause") == [
        ("2024-01", 0.0, "MATCH", 0, "NONE"),
        ("2024-02", -31.2, "VARIANCE", 3, "SOURCE_GAP"),
        ("2024-03", 24.8, "VARIANCE", 0, "ROUNDING_POLICY"),
        ("2024-04", -375.0, "VARIANCE", 0, "REVENUE_SCOPE"),
    ]
    full = reconcile.reconcile(monthly, signed, "full")
    assert rows(full.filter("month = '2024-05'"), "status") == [("MISSING_IN_PIPELINE",)]


def test_variance_in_money_by_cause(spark, staged, products, rows):
    start = dt.date(2024, 1, 1)
    dim = products(product(1, "P1", dt.date(2000, 1, 1), END))
    # ten for a weekday and 20.40 for a Sunday, in two stores
    price = lambda day: 20.4 if day.weekday() == 6 else 10.0
    everything = staged(
        *(line(f"{s}-{k}", price=price(start + dt.timedelta(k)), store=s, day=start + dt.timedelta(k))
          for s in ("S01", "S02") for k in range(121))
    )
    first, last = dt.date(2024, 2, 3), dt.date(2024, 2, 12)
    feed = everything.filter(~((F.col("store_id") == "S02") & F.col("business_date").between(first, last)))
    full, feed_fact = (marts.sales_fact(x, dim) for x in (everything, feed))
    signed = marts.bill_rounded_revenue(full).select(
        "month",
        F.when(F.col("month") == "2024-02", F.col("bill_rounded_revenue"))
        .when(F.col("month") == "2024-03", F.col("line_revenue") + 75.25)
        .otherwise(F.col("line_revenue"))
        .alias("revenue_inr"),
    ).unionByName(spark.createDataFrame([("2023-12", 40.0)], "month string, revenue_inr double"))
    missing = reconcile.missing_days(feed)
    parts = reconcile.variance_parts(
        reconcile.reconcile(reconcile.monthly_revenue(feed_fact), signed, "full"),
        marts.bill_rounded_revenue(feed_fact),
        missing,
        reconcile.weekday_profile(feed, feed_fact, missing),
    )
    # ten days lost, two of them Sundays; in the feed 4 + 2 Sundays of February, each 0.40 above the rounded bill
    assert rows(parts) == [
        ("2023-12", "MISSING_IN_PIPELINE", 0, -40.0, 0.0, 0.0, -40.0),
        ("2024-01", "MATCH", 0, 0.0, 0.0, 0.0, 0.0),
        ("2024-02", "VARIANCE", 10, -117.6, -120.8, 2.4, 0.8),
        ("2024-03", "VARIANCE", 0, -75.25, 0.0, 0.0, -75.25),
        ("2024-04", "MATCH", 0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_missing_days_over_the_whole_span_and_lost_runs(staged, rows):
    start = dt.date(2024, 1, 1)
    daily = lambda store, skipped, n=200: [
        line(store=store, day=start + dt.timedelta(k)) for k in range(n) if k not in skipped
    ]
    # one single day, a trailing outage, a store open every fourth day, and one that starts late
    lines = staged(
        *daily("S01", {50}), *daily("S02", set(), 190), *daily("S03", {k for k in range(200) if k % 4}),
        *daily("S04", set(range(20))),
    )
    missing = rows(reconcile.missing_days(lines))
    by_store = {s: sorted((d - start).days for t, d, lost in missing if t == s and lost) for s in ("S01", "S02", "S03", "S04")}
    assert by_store == {"S01": [], "S02": list(range(190, 200)), "S03": [], "S04": list(range(20))}
    assert sum(s == "S01" for s, *_ in missing) == 1 and sum(s == "S03" for s, *_ in missing) == 150


def test_exports_of_all_dialects_and_resent_files(spark, tmp_path, rows):
    plain = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"
    other = "bill_no;line_no;item_code;quantity;rate;type;txn_time\n"
    (tmp_path / "SALES_S01_20240305.csv").write_text(plain + "B1,1,P1,2,5.5,SALE,08:00\n")
    (tmp_path / "SALES_S01_20240305__R1.csv").write_text(plain + "B1,1,P1,3,5.5,SALE,09:00\n")
    (tmp_path / "SALES_S07_20240306.csv").write_text(other + "B2;1;P2;1;7;SALE;08:00\n")
    (tmp_path / "SALES_S12_20240307.csv").write_text(plain + "B3,1,P3,1,8,TENDER,08:00\n")
    lines = exports.read_exports(spark, str(tmp_path))
    assert lines.schema == STAGED_LINE or lines.columns == STAGED_LINE.names
    assert rows(dedup.keep_latest(lines), "bill_no", "qty", "store_id", "business_date") == [
        ("B1", 3.0, "S01", dt.date(2024, 3, 5)),
        ("B2", 1.0, "S07", dt.date(2024, 3, 6)),
        ("B3", 1.0, "S12", dt.date(2024, 3, 7)),
    ]


def test_exports_are_daily_and_later_copies_are_resent(spark, staged, tmp_path, rows):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 12, 31)]
    sent = [
        line(f"{store}-{day}", copy[0], qty=copy[1], ts=copy[2], store=store, day=day)
        for store in ("S00", "S03", "S08", "S24")
        for day in days
        for copy in ((1, 1.0, "10:00"), (1, 1.0, "10:00"), (1, 2.0, "11:00"), (2, 5.0, "10:30"))
    ]
    standins.write_exports(staged(*sent), str(tmp_path))
    names = {p.stem for p in tmp_path.iterdir()}
    assert len(names) == 24
    assert {f"SALES_S08_20240102{end}" for end in ("", "__R1")} <= names
    got = exports.read_exports(spark, str(tmp_path), standins.EXPORT_DIALECTS)
    assert rows(got.select(*STAGED_LINE.names)) == sorted(sent, key=repr)


def test_loads_read_new_files_only_and_merge_them(spark, tmp_path, rows):
    folder, table, stored = (str(tmp_path / n) for n in ("in", "table", "ledger"))
    os.mkdir(folder)
    head = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"

    def put(name, *lines):
        with open(f"{folder}/{name}.csv", "w") as file:
            file.write(head + "".join(f"{x}\n" for x in lines))

    def load():
        return ledger.load_new_files(spark, folder, table, stored).first()

    put("SALES_S01_20240305", "B1,1,P1,2,5.5,SALE,08:00", "B1,2,P2,1,1,SALE,08:00")
    put("SALES_S02_20240405", "B2,1,P1,2,5.5,SALE,08:00")
    assert tuple(load()) == (1, 2, 0, 0, 3)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").glob("store_id=S02/*/*.parquet")}
    put("SALES_S01_20240305__R1", "B1,1,P1,3,5.5,SALE,09:00")
    put("SALES_S01_20240305__R2", "B1,1,P1,3,5.5,SALE,09:00")
    put("SALES_S03_20240305", "B3,1,P1,1,1,SALE,08:00")
    assert tuple(load()) == (2, 1, 1, 1, 2)
    assert rows(files.read_lake(spark, table), "bill_no", "line_no", "qty") == [
        ("B1", 1, 3.0), ("B1", 2, 1.0), ("B2", 1, 2.0), ("B3", 1, 1.0),
    ]
    assert untouched and {p: p.stat().st_mtime_ns for p in untouched} == untouched
    assert tuple(load()) == (3, 0, 0, 0, 0)
    put("SALES_S02_20240405", "B2,1,P1,9,5.5,SALE,10:00")
    assert tuple(load())[1:] == (0, 1, 0, 1)
    assert rows(files.read_lake(spark, table).filter("store_id = 'S02'"), "bill_no", "qty") == [("B2", 9.0)]
    kinds = rows(ledger.read_ledger(spark, stored), "name", "kind")
    assert ("SALES_S01_20240305__R2.csv", "repeat") in kinds and len(kinds) == 6


def test_file_that_no_dialect_reads_is_an_error(spark, tmp_path):
    header = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"
    (tmp_path / "SALES_S01_20240305.csv").write_text(header)
    (tmp_path / "SALES_S77_20240305.csv").write_text(header)
    with pytest.raises(ValueError, match="SALES_S77"):
        exports.read_exports(spark, str(tmp_path))


def test_malformed_export_value_is_an_error(spark, tmp_path):
    header = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"
    (tmp_path / "SALES_S01_20240305.csv").write_text(header + "B1,one,P1,2,5.5,SALE,08:00\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        exports.read_dialect(spark, str(tmp_path), exports.DIALECTS[0]).collect()


def test_lake_round_trip_prunes_and_reloads_in_place(spark, staged, tmp_path, rows):
    root = str(tmp_path / "lake")
    lines = dedup.with_month(
        staged(line(), line("B2", store="S02"), line("B3", day=dt.date(2024, 4, 1)))
    )
    sinks.write_lake(lines, root)
    sinks.write_lake(lines, root)
    sinks.write_lake(lines.filter("store_id = 'S02'"), root)
    lake = files.read_lake(spark, root)
    assert rows(lake, "bill_no", "store_id", "year_month") == [
        ("B1", "S01", "2024-03"), ("B2", "S02", "2024-03"), ("B3", "S01", "2024-04"),
    ]
    march = lake.filter("year_month = '2024-03'")
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert rows(files.read_lake(spark, root, "2024-03"), "bill_no") == [("B1",), ("B2",)]
    assert files.scanned_files(files.read_lake(spark, root, "2024-04")) == 1
    assert rows(files.read_lake(spark, root, "2031-01")) == []
    part = (F.col("store_id") == "S01") & (F.col("year_month") == "2024-03")
    assert rows(files.scan_report(lake, part)) == [(3, 3, 1, 1)]
    report = files.pruning_report(
        files.file_inventory(spark, root), "store_id=S01/year_month=2024-03/"
    ).first()
    assert (report.total_files, report.part_files) == (3, 1)
    assert 0 < report.part_bytes < report.total_bytes and report.file_reduction_pct == 66.67


def test_upserts(spark, rows):
    existing = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "k int, v string, t int")
    incoming = spark.createDataFrame(
        [(2, "newer", 2), (2, "new", 1), (3, "new", 1), (3, "newest", 3), (3, "newer", 2)], "k int, v string, t int"
    )
    first = sinks.upsert_keep_first(existing, incoming, ["k"], ["t"])
    last = sinks.upsert_keep_last(existing, incoming, ["k"], ["t"])
    assert rows(first, "k", "v") == [(1, "old"), (2, "old"), (3, "new")]
    assert rows(last, "k", "v") == [(1, "old"), (2, "newer"), (3, "newest")]


def test_stored_upserts_write_touched_folders_only(spark, rows, tmp_path):
    root, schema = str(tmp_path / "table"), "k int, v string, t int"
    state = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "table").glob("key_part=*/*.parquet")}
    table = lambda: rows(sinks.read_keyed(spark, root, base.schema), "k", "v")
    base = spark.createDataFrame([(k, "old", 0) for k in range(60)], schema)
    assert sinks.upsert_into(base, root, ["k"], ["t"], "first", 8) == list(range(8))
    before = state()
    batch = spark.createDataFrame([(7, "new", 1), (7, "newest", 2), (100, "b", 2), (100, "a", 1)], schema)
    written = sinks.upsert_into(batch, root, ["k"], ["t"], "first", 8)
    assert len(written) == 1 and dict(table())[100] == "a" and dict(table())[7] == "old"
    after = state()
    kept = {f for f in before if f"key_part={written[0]}/" not in f}
    assert len(kept) >= 7 and all(after[f] == before[f] for f in kept) and not set(before) - kept & set(after) - kept
    assert sinks.upsert_into(batch, root, ["k"], ["t"], "first", 8) == [] and state() == after
    assert len(sinks.upsert_into(batch, root, ["k"], ["t"], "last", 8)) in (1, 2)
    assert dict(table()) == {**{k: "old" for k in range(60)}, 7: "newest", 100: "b"} and len(table()) == 61
    assert sinks.upsert_into(batch, root, ["k"], ["t"], "last", 8) == []
    assert sinks.upsert_into(batch.limit(0), root, ["k"], ["t"], "last", 8) == [] and len(table()) == 61
    with pytest.raises(ValueError):
        sinks.upsert_into(batch, root, ["k"], ["t"], "any")


def test_small_readers(spark, tmp_path, rows):
    (tmp_path / "finance.csv").write_text("month,revenue_inr\n2024-01,5250.75\n")
    (tmp_path / "pairs.csv").write_text("notice_id_a,notice_id_b,label\nN1,N2,same\n")
    (tmp_path / "truth.json").write_text(
        '{\n "monthly_net_revenue_in_folder": {"2024-01": 5250.75},\n'
        ' "finance_notes": {"2024-03": "bulk"}, "cluster_size_hist": {"1": 3350}\n}'
    )
    notices = tmp_path / "notices"
    notices.mkdir()
    header = "notice_id,portal_id,published_at,title,body,estimated_value,closing_date\n"
    (notices / "a.csv").write_text(header + 'N1,P001,2024-01-01,T,"two\nlines, ""quoted""",1.5,2024-02-01\n')
    (notices / "b.csv").write_text(header + "N2,P002,2024-01-02,T,one,,2024-02-01\n")
    assert rows(files.read_finance(spark, str(tmp_path / "finance.csv"))) == [("2024-01", 5250.75)]
    assert rows(files.read_labelled_pairs(spark, str(tmp_path / "pairs.csv"))) == [("N1", "N2", "same")]
    truth = files.read_truth(spark, str(tmp_path / "truth.json"))
    assert rows(files.expected_months(truth)) == [("2024-01", 5250.75)]
    assert rows(files.read_notices(spark, str(notices)), "notice_id", "body", "estimated_value") == [
        ("N1", 'two\nlines, "quoted"', 1.5), ("N2", "one", None),
    ]


def test_whole_job_reads_its_lines_once_and_adds_up(spark, staged, products, tmp_path, rows):
    from mercatura.plans import retail

    categories = dims.with_discount_category(
        spark.createDataFrame([("C01", "Biscuits", "Food", 0.18)], CATEGORY)
    )
    dim = dims.with_discount_product(products(product(1, "P1", dt.date(1990, 1, 1), END)))
    stores = spark.createDataFrame([("S01", "One", "X")], "store_id string, store_name string, city string")
    signed = spark.createDataFrame([("1998-10", 20.0)], "month string, revenue_inr double")
    day = dt.date(1998, 10, 5)
    raw = staged(
        line("A", 1, qty=3.0, day=day), line("A", 1, qty=3.0, day=day),
        line("A", 2, "DISC", 1.0, -5.0, "DISCOUNT", day=day),
    )
    results = retail.run(spark, raw, stores, dim, categories, signed, str(tmp_path))
    assert rows(results["rev_by_month"], "net_revenue") == [(25.0,)]
    assert rows(results["federated_topn"], "revenue") == [(30.0,)]
    assert rows(results["variance_class"], "variance_inr", "cause") == [(5.0, "REVENUE_SCOPE")]
    for name, column in (("rev_by_store", "net_revenue"), ("rev_by_category", "net_revenue")):
        assert sum(r[0] for r in rows(results[name], column)) == 25.0


def test_small_dimensions_are_broadcast(spark):
    """Default members keep the size of their dimension known, so no fact is shuffled to be joined."""
    from mercatura.plans import retail

    for name in ("fact_sales", "federated_topn", "rev_by_category", "prices_as_of"):
        plan = retail.QUERIES[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
        joins = plan.split("Scan parquet")[0] if name == "fact_sales" else plan
        assert "BroadcastHashJoin" in joins and "SortMergeJoin" not in joins, name


def test_shared_tables_follow_their_source(spark, tmp_path):
    from mercatura.session import stage_once

    folder = str(tmp_path / "in")
    spark.range(5).write.parquet(f"{folder}/a.parquet")
    read = lambda: spark.read.option("recursiveFileLookup", True).parquet(folder).distinct()
    assert stage_once(spark, folder, "ids", read).count() == 5
    first = stage_once(spark, folder, "ids", read)
    assert first is stage_once(spark, folder, "ids", read)
    spark.range(5, 50).write.parquet(f"{folder}/b.parquet")
    assert stage_once(spark, folder, "ids", read).count() == 50


def test_lines_are_deduplicated_where_their_bill_is(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = dedup.keep_latest(standins.raw_lines(spark, "/root/testdata/sf0.001"))
        plan = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan[: plan.index("Generate")]


def test_texts_of_exports_are_not_shuffled_and_names_given_are_kept(spark, staged, rows):
    lines = staged(line("A", 1), line("A", 1, ts="1998-10-09"), line("B", 2))
    made = standins.export_files(lines)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Exchange")
    assert rows(standins.export_files(standins.export_lines(lines)), "export") == rows(made, "export")
    named = lines.withColumn("export", F.lit("one"))
    assert rows(standins.export_files(named), "export") == [("one",)]


def test_names_of_exports_need_no_further_shuffle(spark, staged, rows):
    sent = [line("A", 1), line("A", 1, ts="11:00"), line("A", 1), line("B", 2), line(None, 3), line("C", None)]
    named = standins.export_lines(staged(*sent).repartition(3, "bill_no"))
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(named, "bill_no", "raw_ts", "export") == [
        ("A", "10:00", "SALES_S01_20240305"), ("A", "10:00", "SALES_S01_20240305"),
        ("A", "11:00", "SALES_S01_20240305__R1"), ("B", "10:00", "SALES_S01_20240305"),
    ]


def test_compared_lines_travel_without_their_key_in_the_text(staged, rows):
    before = [line("A", 1), line("A", 2, price=None), line(None, 3), line("C", 4, None, None, None, None), line("D", 5)]
    after = [line("A", 1, price=11.0), line("D", 5), line("D", 5), line(None, None, None, None, None, None)]
    sides = [dedup.with_month(staged(*x)) for x in (before, after)]
    changed = digests.changed_lines(*sides, sides[0].select("store_id", "year_month").distinct())
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "concat_ws(:, bill_no" not in plan[plan.rindex("Exchange") :]
    assert rows(changed, "text", "surplus") == [
        ("", 1), ("3:P1:1.00:10.00:SALE", -1), ("A:1:P1:1.00:10.00:SALE", -1), ("A:1:P1:1.00:11.00:SALE", 1),
        ("A:2:P1:1.00:SALE", -1), ("C:4", -1), ("D:5:P1:1.00:10.00:SALE", 1),
    ]
    texts = sides[0].select(dedup.line_text().alias("text"))
    assert rows(texts)[1:3] == [("A:1:P1:1.00:10.00:SALE",), ("A:2:P1:1.00:SALE",)]


def test_headers_of_exports_are_not_shuffled(staged):
    plan = standins.export_files(staged(line("A", 1), line("B", 2, store="S07")))._jdf.queryExecution().executedPlan().toString()
    assert "keys=[export" in plan and "header" not in plan


def test_staged_tables_and_partitions_are_written_with_zstd(spark, staged, tmp_path):
    table = stage(staged(line()), "small")
    assert all(".zstd." in path for path in table.inputFiles())
    sinks.write_lake(dedup.with_month(table), str(tmp_path / "lake"))
    assert [p.name for p in (tmp_path / "lake").glob("*/*/*.zstd.parquet")]
    assert all(".snappy." in path for path in stage(staged(line()), "small", compression="snappy").inputFiles())
