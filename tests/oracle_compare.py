"""Side-by-side check of every driver query against its DuckDB oracle.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Prints one line per query: row counts, column names, and whether the
order-insensitive multisets of rows are equal (doubles compared exactly,
timestamps/dates as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in records), key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    from parcelbeam.session import build_session
    import __spark_entry__ as E

    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    oracles = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
        if name not in oracles:
            print(f"ROWS-ONLY {name}: spark={len(s_rows)}")
            continue
        res = con.execute(oracles[name])
        o_cols = [d[0] for d in res.description]
        o_rows = rows_of(o_cols, res.fetchall())
        same_cols = sorted(s_cols) == sorted(o_cols)
        same = same_cols and s_rows == o_rows
        bad += not same
        print(f"{'MATCH' if same else 'DIFF '} {name:28s} spark={len(s_rows):6d} oracle={len(o_rows):6d} cols={'ok' if same_cols else (sorted(s_cols), sorted(o_cols))}", flush=True)
        if same_cols and not same:
            sset, oset = set(map(repr, s_rows)), set(map(repr, o_rows))
            print("   spark-only:", list(sset - oset)[:3])
            print("   oracle-only:", list(oset - sset)[:3])
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
