"""Compare registered queries with their DuckDB oracle SQL (used by tests and by hand).

    python -m sparkloom.plans.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLE_NAMES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 12))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duckdb={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} differing rows, first: spark={diff[0][0]} duckdb={diff[0][1]}")
    return problems, len(s_rows), t1 - t0, t2 - t1


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from sparkloom.plans.oracle import ORACLE_SQL
    from sparkloom.plans.registry import all_queries
    from sparkloom.session import get_spark

    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(args.sf)
    queries = all_queries()
    names = args.names or sorted(queries)
    bad = 0
    for name in names:
        sql = ORACLE_SQL.get(name)
        if sql is None:
            t0 = time.time()
            n = queries[name](spark, args.sf).count()
            print(f"{name:32s} rows-only {n} rows {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            problems, n, ts, td = compare(spark, con, name, queries[name], sql, args.sf)
        except Exception as exc:  # report and go on
            problems, n, ts, td = [f"error {type(exc).__name__}: {str(exc)[:400]}"], -1, 0, 0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{name:32s} {status} rows={n} spark={ts:.1f}s duckdb={td:.1f}s {'; '.join(problems)}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
