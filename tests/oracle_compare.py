"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  The check is
row count + column names + order-insensitive values, as the driver does it.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    ddf = con.execute(sql).fetchdf()
    scols = sorted(sdf.columns)
    dcols = sorted(ddf.columns)
    if scols != dcols:
        return False, f"columns differ: spark={scols} oracle={dcols}", t1 - t0
    drecs = ddf.to_dict("records")
    a, b = rows_of(srows, scols), rows_of(drecs, scols)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} oracle={len(b)}", t1 - t0
    if a != b:
        sa, sb = set(a), set(b)
        only_s = list(sa - sb)[:3]
        only_d = list(sb - sa)[:3]
        return False, f"values differ; spark-only {only_s} oracle-only {only_d}", t1 - t0
    return True, f"{len(a)} rows", t1 - t0


def main(argv):
    from docweave.session import get_session

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if os.environ.get("DW_PLAIN_SESSION"):
        # the driver's kind of session: none of our defaults, another time zone
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.session.timeZone", os.environ["DW_PLAIN_SESSION"]).getOrCreate())
    else:
        spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in oracles:
            df = fn(spark, sf_dir)
            print(f"[rows-only] {name}: {df.count()} rows", flush=True)
            continue
        try:
            ok, msg, secs = compare(spark, con, name, fn, oracles[name], sf_dir)
        except Exception as e:  # report and continue
            ok, msg, secs = False, f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"[{'OK' if ok else 'FAIL'}] {name} ({secs:.1f}s): {msg}", flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
