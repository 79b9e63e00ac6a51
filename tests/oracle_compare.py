"""Compare registered Spark queries with their DuckDB oracle SQL (local check tool).

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per query: OK / MISMATCH with row counts and the first differences.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lakeshore.sources.tables import TABLES  # noqa: E402


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = sorted(tuple(canon(r[i]) for i in order) for r in rows)
    return names, out


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, key, fn, sql):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    st = time.time() - t
    if sql is None:
        return f"{key}: rows-only spark={len(s_rows)} ({st:.1f}s)", True
    t = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    dt_ = time.time() - t
    sn, sr = normalise(s_cols, s_rows)
    dn, dr = normalise(d_cols, d_rows)
    ok = sn == dn and sr == dr
    msg = f"{key}: {'OK' if ok else 'MISMATCH'} rows spark={len(sr)} duck={len(dr)} ({st:.1f}s/{dt_:.1f}s)"
    if sn != dn:
        msg += f"\n   cols spark={sn}\n   cols duck ={dn}"
    elif sr != dr:
        a, b = set(sr), set(dr)
        msg += f"\n   only spark: {sorted(a - b)[:3]}\n   only duck : {sorted(b - a)[:3]}"
    return msg, ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from lakeshore.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            msg, ok = compare(spark, con, sf_dir, key, qs[key], oracle.get(key))
        except Exception as exc:  # report and continue
            msg, ok = f"{key}: ERROR {type(exc).__name__}: {str(exc)[:400]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"done: {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
