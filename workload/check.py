"""Run queries in Spark and their twins in DuckDB, and compare the rows.

    python -m workload.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import time

import duckdb
from pyspark.sql import SparkSession

from workload import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(f"{value:.17g}") if abs(value) < 2**53 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canonical(v)) for k, v in value.items()))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark: SparkSession, sf: str, name: str, build, sql: str | None) -> str:
    began = time.time()
    frame = build(spark, sf)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - began
    if sql is None:
        return f"rows-only {len(got)} rows {spent:.1f}s"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"FAIL columns {sorted(frame.columns)} vs {sorted(columns)}"
    if got != want:
        left = [r for r in got if r not in set(want)][:2] if len(got) < 20000 else []
        right = [r for r in want if r not in set(got)][:2] if len(want) < 20000 else []
        return f"FAIL {len(got)} vs {len(want)} rows\n   spark {left}\n   sql   {right}"
    return f"ok {len(got)} rows {spent:.1f}s"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, q in all_queries().items():
        if args.names and name not in args.names:
            continue
        if args.module and not any(
            m in q.build.__closure__[0].cell_contents.__module__ for m in args.module.split(",")
        ):
            continue
        try:
            verdict = compare(spark, args.sf, name, q.build, q.sql)
        except Exception as error:  # keep going: one broken query must not hide the others
            verdict = f"FAIL {type(error).__name__}: {str(error)[:600]}"
        failed += verdict.startswith("FAIL")
        print(f"{name}: {verdict}", flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
