"""Run each ``queries()`` entry on Spark and its ``oracle_sql()`` on DuckDB and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, out


def _key(r):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in r)


def compare(spark_pdf, duck_pdf, tol=0.0):
    sc, sr = rows_of(spark_pdf)
    dc, dr = rows_of(duck_pdf)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    sr = sorted(sr, key=lambda r: tuple(str(x) for x in r))
    dr = sorted(dr, key=lambda r: tuple(str(x) for x in r))
    bad = 0
    first = None
    for a, b in zip(sr, dr):
        for x, y in zip(a, b):
            same = (x == y) or (isinstance(x, float) and isinstance(y, (float, int)) and abs(x - y) <= tol)
            if not same:
                bad += 1
                if first is None:
                    first = (a, b)
                break
    if bad:
        return False, f"{bad} rows differ; first: spark={first[0]} duck={first[1]}"
    return True, f"{len(sr)} rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from oeeflow.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    ok_n = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        ts = time.time() - t
        if name not in sqls:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            dpdf = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        ok, msg = compare(sdf, dpdf)
        if not ok:
            ok2, _ = compare(sdf, dpdf, tol=1e-9)
            msg += " (within 1e-9)" if ok2 else ""
        ok_n += ok
        print(f"{'OK  ' if ok else 'DIFF'} {name}: {msg} {ts:.1f}s")
    print(f"{ok_n} exact matches")


if __name__ == "__main__":
    main()
