"""Run a registered Spark job and its DuckDB oracle on the same tables and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Comparison is order-insensitive: same column names, same row count, and the
same multiset of rows (floats compared exactly after both engines cast to
DOUBLE; NaN/None treated as equal).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return (3, v.isoformat())
    return (4, str(v))


def rows_of(cols, records, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in records)


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir: str, key: str, job, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = job(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if s_types != d_types:
        return False, f"types differ: spark={s_types} duck={d_types}"
    order = sorted(s_cols)
    a, b = rows_of(s_cols, s_rows, order), rows_of(d_cols, d_rows, order)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({len(a)} rows), first: {diff}"
    return True, f"{len(a)} rows, spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from claimscope.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for key in keys or list(q):
        if key not in o:
            sdf = q[key](spark, sf_dir)
            print(f"{key:40s} NO-ORACLE rows={sdf.count()}")
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, key, q[key], o[key])
        except Exception as e:  # report and continue with the next key
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{key:40s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
