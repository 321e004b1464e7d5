"""Compare registered queries with their DuckDB statements: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from mercatura.session import build_session  # noqa: E402


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([tuple(plain(r[i]) for i in order) for r in rows]), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    spark_time = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got)} rows in {spark_time:.1f}s"
    started = time.time()
    cursor = con.execute(sql)
    names, want = [d[0] for d in cursor.description], cursor.fetchall()
    duck_time = time.time() - started
    note = f"{len(got)} rows, spark {spark_time:.1f}s, duckdb {duck_time:.1f}s"
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = sorted_rows(df.columns, got), sorted_rows(names, want)
    if mine == theirs:
        kinds = dict(zip(names, (str(d[1]) for d in cursor.description)))
        odd = {k: v for k, v in kinds.items() if v in ("HUGEINT", "UBIGINT", "UINTEGER")}
        return f"ok {note} {odd or ''}"
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b][:3]
    return f"DIFFERENT {note} against {len(theirs)}: {differing}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = tables(folder)
    for name in sys.argv[2:] or entry.queries():
        try:
            print(f"{name:28s} {compare(spark, con, name, folder)}", flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} ERROR {type(e).__name__} {str(e)[:600]}", flush=True)
