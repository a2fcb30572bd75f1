"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB on one data directory and compare the results.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``. Prints one line per key and exits non-zero on a mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, key: str, sf_dir: str, query, sql: str | None):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(key=key, ok=None, rows=len(s_rows), spark_sec=t1 - t0)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    ok = ok_cols and a == b
    info = dict(key=key, ok=ok, rows=len(s_rows), oracle_rows=len(d_rows), spark_sec=round(t1 - t0, 2))
    if not ok_cols:
        info["columns"] = (sorted(s_cols), sorted(d_cols))
    elif not ok:
        sa, sb = set(a), set(b)
        info["only_spark"] = list(sa - sb)[:3]
        info["only_oracle"] = list(sb - sa)[:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from refnet.session import build_session

    import __spark_entry__ as entry

    spark = build_session("local[8]", **{"spark__sql__shuffle__partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key, q in qs.items():
        if wanted and key not in wanted:
            continue
        try:
            info = compare(spark, con, key, sf_dir, q, sqls.get(key))
        except Exception as exc:  # report and go on
            info = dict(key=key, ok=False, error=repr(exc)[:400])
        bad += info.get("ok") is False
        print(info, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
