"""Run registered queries on Spark and their SQL twins on DuckDB, compare.

Usage: python tests/compare_oracle.py [sf_dir] [query ...]
Prints one line per query: OK / MISMATCH with counts and a sample diff.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from promofund.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), [columns[i] for i in order]


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: no oracle (rows={len(s_rows)}) spark={t1 - t0:.1f}s"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: COLUMNS differ spark-only={set(s_cols) - set(d_cols)} duck-only={set(d_cols) - set(s_cols)}"
    a, cols = rows_of(s_cols, s_rows)
    b, _ = rows_of(d_cols, d_rows)
    if a == b:
        return True, f"{name}: OK rows={len(a)} spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"
    sa, sb = set(a), set(b)
    only_a = sorted(sa - sb)[:3]
    only_b = sorted(sb - sa)[:3]
    return False, (f"{name}: MISMATCH spark={len(a)} duck={len(b)} cols={cols}\n  spark-only {only_a}\n  duck-only  {only_b}")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    from promofund import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n, con)
        except Exception as exc:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
