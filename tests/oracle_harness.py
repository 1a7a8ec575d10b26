"""Side-by-side check of ``queries()`` against ``oracle_sql()`` on DuckDB.

Mirrors the driver's gate: row count, column names, order-insensitive values.
Run as a script: ``python tests/oracle_harness.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if exact else round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item(), exact)
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        seq = v.tolist() if hasattr(v, "tolist") else v
        return tuple(_norm(x, exact) for x in seq)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, exact)) for k, x in v.items()))
    return v


def rows_of(cols, records, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], exact) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, key: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return res
    d_rows = [tuple(r[d_cols.index(c)] for c in s_cols) for r in d_rows]
    if len(s_rows) != len(d_rows):
        res["status"] = "ROWCOUNT"
        return res
    if rows_of(s_cols, s_rows, True) == rows_of(s_cols, d_rows, True):
        res["status"] = "exact"
    elif rows_of(s_cols, s_rows, False) == rows_of(s_cols, d_rows, False):
        res["status"] = "approx"
        a, b = rows_of(s_cols, s_rows, True), rows_of(s_cols, d_rows, True)
        res["first_diff"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
    else:
        a, b = rows_of(s_cols, s_rows, False), rows_of(s_cols, d_rows, False)
        res["status"] = "MISMATCH"
        res["first_diff"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from cartwheel.session import local_session
    import __spark_entry__ as E
    spark = local_session()
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], ors.get(k), con)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("exact", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} ok / {bad} not exact")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
