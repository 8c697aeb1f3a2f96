"""Spark-vs-DuckDB comparison: row count, column names, order-insensitive values.

Usable from pytest and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], rows


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark, sf_dir, name, fn, sql, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_rows = spark_rows(fn(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, sql)
    res = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": s_cols == d_cols, "values_match": Counter(s_rows) == Counter(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    elif not res["values_match"]:
        a, b = Counter(s_rows), Counter(d_rows)
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_oracle"] = list((b - a).elements())[:3]
    res["ok"] = res["cols_match"] and res["values_match"]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from wideflow.session import get_session
    spark = get_session("local[8]")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"query": name, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as e:  # report and continue
            r = {"query": name, "ok": False, "error": repr(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
