"""Side-by-side check of a registered query against its DuckDB oracle (like the driver's)."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    res["schema_match"] = sorted(s_cols) == sorted(d_cols)
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    res["value_match"] = hs == hd
    if not res["value_match"] or not res["schema_match"]:
        res["cols"] = (s_cols, d_cols)
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        res["only_spark"] = [x[:300] for x in only_s]
        res["only_duck"] = [x[:300] for x in only_d]
    return res


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from textloom.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark = build_session(os.environ.get("MASTER", "local[8]"), 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or sorted(qs):
        try:
            r = compare(spark, n, qs[n], sqls.get(n), sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"query": n, "error": repr(exc)[:800]}
        ok = r.get("oracle") == "none" or (r.get("value_match") and r.get("schema_match"))
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
