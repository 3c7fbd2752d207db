"""Run catalogue queries in Spark and their SQL oracle in DuckDB and compare.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [name ...]

Per query prints: rows (spark/duckdb), column-name match, dtype kinds and
whether the sorted values match exactly and within 1e-9 relative tolerance.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None else (str(list(v)) if isinstance(v, (list, np.ndarray)) else str(v)))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(a: pd.DataFrame, b: pd.DataFrame) -> tuple[bool, bool, str]:
    if sorted(a.columns) != sorted(b.columns):
        return False, False, f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}"
    if len(a) != len(b):
        return False, False, f"rows {len(a)} vs {len(b)}"
    a, b = _norm(a), _norm(b)
    exact, close, bad = True, True, []
    for c in a.columns:
        x, y = a[c], b[c]
        if pd.api.types.is_numeric_dtype(x) and pd.api.types.is_numeric_dtype(y):
            xv, yv = x.astype(float).to_numpy(), y.astype(float).to_numpy()
            eq = (xv == yv) | (np.isnan(xv) & np.isnan(yv))
            cl = np.isclose(xv, yv, rtol=1e-9, atol=1e-9, equal_nan=True)
            if not eq.all():
                exact = False
            if not cl.all():
                close = False
                i = int(np.argmin(cl))
                bad.append(f"{c}[{i}] {xv[i]!r} vs {yv[i]!r}")
        else:
            xs = x.astype(str).where(x.notna(), None)
            ys = y.astype(str).where(y.notna(), None)
            if not (xs.fillna("<NULL>") == ys.fillna("<NULL>")).all():
                exact = close = False
                i = int(np.argmin((xs.fillna("<NULL>") == ys.fillna("<NULL>")).to_numpy()))
                bad.append(f"{c}[{i}] {xs.iloc[i]!r} vs {ys.iloc[i]!r}")
    return exact, close, "; ".join(bad[:4])


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from furrow.plans.registry import all_oracle_sql, all_queries
    from furrow.session import build_session

    spark = build_session(cpus=8)
    qs, sqls = all_queries(), all_oracle_sql()
    con = duckdb.connect()
    for tname in TABLES:
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{args.sf}/{tname}.parquet')")
    names = args.names or list(qs)
    failures = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, args.sf)
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            failures += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(sp):7d} (no oracle) {dt:.1f}s")
            continue
        try:
            dd = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {str(e)[:300]}")
            failures += 1
            continue
        exact, close, msg = compare(sp, dd)
        status = "EXACT" if exact else ("CLOSE" if close else "MISMATCH")
        failures += 0 if close else 1
        print(f"{name:28s} rows={len(sp):7d}/{len(dd):7d} {status:8s} {dt:.1f}s {msg}")
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
