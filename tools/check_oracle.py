"""Run registered queries on Spark and their SQL on DuckDB, and compare all rows.

Usage: python tools/check_oracle.py [sf_dir] [name part ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb

from riskframe.queries import all_queries, all_sql
from riskframe.session import local_session


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    parts = args[1:]
    spark = local_session()
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    bad = 0
    sqls = all_sql()
    for name, run in all_queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name not in sqls:
                print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
                bad += not got
                continue
            cur = con.execute(sqls[name])
            columns = [c[0] for c in cur.description]
            kinds = {c[0]: str(c[1]) for c in cur.description}
            want = rows_of(columns, cur.fetchall())
        except Exception as e:
            print(f"ERROR {name} {type(e).__name__}: {str(e)[:600]}", flush=True)
            bad += 1
            continue
        if sorted(df.columns) != sorted(columns):
            print(f"COLS  {name} {sorted(df.columns)} {sorted(columns)}", flush=True)
            bad += 1
        elif got != want:
            diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
            print(f"DIFF  {name} rows {len(got)} {len(want)} first {diff}", flush=True)
            bad += 1
        else:
            alias = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
            types = [
                f"{n}:{t}/{kinds[n]}" for n, t in df.dtypes if alias.get(t, t) != kinds[n].upper()
            ]
            print(f"ok    {name} {len(got)} {took:.1f}s {' '.join(types)}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
