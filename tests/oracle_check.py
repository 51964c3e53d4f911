"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive values).  Usage:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    ts = time.time() - t0
    if sql is None:
        return {"name": name, "rows": len(sdf), "status": "rows-only", "spark_s": round(ts, 2)}
    ddf = con.sql(sql).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    status = "ok"
    detail = ""
    if sc != dc:
        status, detail = "cols", f"spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        status, detail = "count", f"spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        status, detail = "values", str(diff)
    return {"name": name, "rows": len(sdf), "status": status, "detail": detail, "spark_s": round(ts, 2)}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from affinity.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": "error", "detail": repr(e)[:400]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
