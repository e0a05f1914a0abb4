"""Compare registered queries with their SQL twins on DuckDB.

Used by the tests and as a CLI::

    python tools/oracle_compare.py [sf_dir] [name ...]

Rows are compared as multisets after sorting columns by name; doubles must be
equal (the registered SQL is written so that both engines round the same).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, pd.Timestamp):
        if v.tzinfo is not None:
            v = v.tz_convert("UTC").tz_localize(None)
        return v.to_pydatetime()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.astimezone(__import__("datetime").timezone.utc).replace(tzinfo=None)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    left = sdf.toPandas()
    t1 = time.time()
    right = con.execute(sql).fetchdf()
    res = {"name": name, "spark_rows": len(left), "sql_rows": len(right), "spark_sec": round(t1 - t0, 2)}
    lc, rc = sorted(left.columns), sorted(right.columns)
    if lc != rc:
        res.update(ok=False, why=f"columns differ: {lc} vs {rc}")
        return res
    if len(left) != len(right):
        res.update(ok=False, why="row count differs")
        return res
    lr, rr = _rows(left), _rows(right)
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    if bad:
        res.update(ok=False, why=f"{len(bad)} rows differ", sample=[(str(a), str(b)) for a, b in bad[:3]],
                   columns=lc)
        return res
    res["ok"] = True
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tarmac.plans.registry import all_queries
    from tarmac.session import local_session

    extra = {}
    if os.environ.get("ORACLE_SESSION_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["ORACLE_SESSION_TZ"]
    for kv in filter(None, os.environ.get("ORACLE_CONF", "").split(",")):  # "k=v,k=v"
        k, v = kv.split("=", 1)
        extra[k] = v
    spark = local_session(8, int(extra.pop("spark.sql.shuffle.partitions", 8)), extra=extra or None)
    con = duck(sf_dir)
    qs = all_queries()
    failed = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        if not q.sql:
            t0 = time.time()
            n = q.fn(spark, sf_dir).count()
            print(f"--   {name}: no SQL twin, {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            r = compare(spark, name, q.fn, q.sql, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        failed += not r["ok"]
        print(("OK  " if r["ok"] else "FAIL"), r)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
