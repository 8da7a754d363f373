"""Run catalog queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (floats rounded to
9 significant digits), the way the driver's correctness gate does.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

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
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def normalise(rows):
    out = [tuple(_norm(v) for v in r) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = query(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return True, f"rows-only {len(rows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: spark={cols} oracle={ocols}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    if len(rows) != len(orows):
        return False, f"row count spark={len(rows)} oracle={len(orows)}"
    a, b = normalise(rows), normalise(orows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    return True, f"{len(rows)} rows ({t1 - t0:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from wirelake.session import get_session

    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as exc:  # report and go on
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
