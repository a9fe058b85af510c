"""Run every workload in Spark and its SQL text in DuckDB on one scale and
compare column names, row counts and (order-insensitive) values.

Used by ``tests/test_workloads.py``; also runnable by hand:
``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    t_spark = time.time() - t0
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(ocols) != cols:
        return False, f"{name}: columns {cols} vs oracle {sorted(ocols)}"
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in orows), key=_key)
    if len(got) != len(want):
        return False, f"{name}: {len(got)} rows vs oracle {len(want)}"
    if got != want:
        bad = next(i for i, (a, b) in enumerate(zip(got, want)) if a != b)
        return False, f"{name}: first difference at {bad}: {got[bad]} vs {want[bad]}"
    return True, f"{name}: {len(got)} rows equal ({t_spark:.1f}s)"


def main(argv):
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    failed = 0
    for name in names:
        if name not in o:
            df = q[name](spark, sf_dir)
            print(f"{name}: no SQL; {df.count()} rows")
            continue
        ok, msg = compare(spark, con, name, q[name], o[name], sf_dir)
        failed += not ok
        print(("OK   " if ok else "FAIL ") + msg, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv))
