"""Run catalog queries in Spark and their SQL in DuckDB on the same Parquet tables and compare."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{d}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _norm(v)) for k, v in value.items())
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, key, fn, text, d):
    t = time.time()
    df = fn(spark, d)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t
    if text is None:
        return "rows", f"{len(got)} rows", took
    rel = con.execute(text)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    if sorted(names) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} != {sorted(names)}", took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return "FAIL", f"rows {len(a)} != {len(b)}; only spark {[x for x in a if x not in set(b)][:2]} only duck {[x for x in b if x not in set(a)][:2]}", took
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return "FAIL", f"{len(bad)} of {len(a)} differ; {sorted(names)} {bad[0]}", took
    return ("ok" if a else "EMPTY"), f"{len(a)} rows", took


if __name__ == "__main__":
    from tidemark.session import local_session
    import __spark_entry__ as entry

    d = sys.argv[1]
    spark = local_session(8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duck(d)
    wanted = sys.argv[2:] or list(queries)
    failed = 0
    for key in wanted:
        try:
            status, note, took = compare(spark, con, key, queries[key], oracle.get(key), d)
        except Exception as e:
            status, note, took = "ERROR", str(e)[:900], 0
        spark.catalog.clearCache()
        failed += status in ("FAIL", "ERROR", "EMPTY")
        print(f"{status:6} {key:32} {took:6.2f}s {note[:700]}", flush=True)
    print("failed", failed, "of", len(wanted))
