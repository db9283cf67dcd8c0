"""Run named queries in Spark and their SQL twins in DuckDB; compare.

Usable from tests and from the command line:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else float(f"{float(v):.12g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, name: str, con=None):
    from cordon.plans import catalog, oracle
    df = catalog.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None}
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    diff = None
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                diff = (x, y)
                break
    return {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows),
            "cols_match": ok_cols, "values_match": a == b,
            "spark_cols": s_cols, "oracle_cols": d_cols, "first_diff": diff}


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from cordon.session import local_session
    from cordon.plans import catalog
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(catalog.queries())
    spark = local_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:500]}
        good = r.get("oracle") is None and "error" not in r or (r.get("cols_match") and r.get("values_match"))
        bad += not good
        print(("OK  " if good else "BAD ") + str(r if not good else {k: r[k] for k in ("name", "rows")}), flush=True)
    print("mismatches:", bad)
