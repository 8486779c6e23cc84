"""Run every registered query in Spark and its SQL oracle in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: row count, column names, and the multiset of rows after
normalising values (floats to 9 significant digits, timestamps naive);
with ORACLE_EXACT=1 floats must be bit-equal.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        order = sorted(range(len(scols)), key=lambda i: scols[i])
        dorder = [dcols.index(scols[i]) for i in order]
        sn = sorted((tuple(_norm(r[i]) for i in order) for r in srows), key=_key)
        dn = sorted((tuple(_norm(r[i]) for i in dorder) for r in drows), key=_key)
        if sn != dn:
            diff = [(a, b) for a, b in zip(sn, dn) if a != b][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(srows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            problems, n, secs = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            problems, n, secs = [f"error {type(exc).__name__}: {str(exc)[:400]}"], -1, 0.0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:28s} rows={n:<7d} {secs:6.2f}s {'; '.join(problems)}", flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
