"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive value hash.
"""
from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2**53:  # nullable ints arrive as floats
            return str(int(v))
        return f"{round(v, 6) + 0.0:.6f}"
    if hasattr(v, "isoformat"):
        if hasattr(v, "hour") and (v.hour, v.minute, v.second) == (0, 0, 0):
            return v.isoformat()[:10]
        return v.isoformat()
    if hasattr(v, "tolist"):
        return str(v.tolist())
    if isinstance(v, int):
        return str(v)
    return str(v)


def frame_hash(pdf):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_canon(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return cols, len(rows), h, rows


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"key": key, "rows": len(sp), "oracle": None, "spark_s": round(t1 - t0, 2)}
    dk = con.execute(sql).df()
    t2 = time.time()
    sc, sn, sh, srows = frame_hash(sp)
    dc, dn, dh, drows = frame_hash(dk)
    res = {"key": key, "rows": sn, "oracle_rows": dn, "cols_match": sc == dc,
           "hash_match": sh == dh, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sc != dc:
        res["spark_cols"], res["oracle_cols"] = sc, dc
    elif sh != dh:
        diff_s = sorted(set(srows) - set(drows))[:3]
        diff_d = sorted(set(drows) - set(srows))[:3]
        res["spark_only"], res["oracle_only"] = diff_s, diff_d
    return res


def main():
    import __spark_entry__ as E
    from pregame.session import local_session
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    keys = args or list(qs)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "error": repr(e)[:2000]}
        ok = r.get("oracle") is None and "error" not in r and "hash_match" not in r or r.get("hash_match")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")


if __name__ == "__main__":
    main()
