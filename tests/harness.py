"""Spark-vs-DuckDB comparison for registered queries.

Mirrors the driver's gate: same row count, same column names, and the
same multiset of rows (order-insensitive, exact values). Usable from
pytest and from the command line:

    python tests/harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            if getattr(s.dt, "tz", None) is not None:
                s = s.dt.tz_convert("UTC").dt.tz_localize(None)
            df[c] = s.astype("datetime64[us]").astype(str)
        elif s.dtype == object:
            df[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and pd.isna(v)) else
                          (str(v) if not isinstance(v, (bytes, bytearray)) else bytes(v).decode()))
        elif pd.api.types.is_bool_dtype(s) or pd.api.types.is_integer_dtype(s) or pd.api.types.is_float_dtype(s):
            df[c] = s.astype("float64") if not pd.api.types.is_bool_dtype(s) else s.astype(object)
    df = df.astype(object).where(pd.notna(df), None)
    return df.sort_values(list(df.columns), key=lambda col: col.map(repr)).reset_index(drop=True)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows differ: spark {len(spark_pdf)} vs duckdb {len(duck_pdf)}"
    a, b = _norm(spark_pdf), _norm(duck_pdf)
    diff = (a != b) & ~(a.isna() & b.isna())
    bad = diff.any(axis=1)
    if bad.any():
        cols = [c for c in a.columns if diff[c].any()]
        i = bad.idxmax()
        return False, (f"{int(bad.sum())} rows differ in {cols}; first: "
                       f"spark={a.loc[i, cols].to_dict()} duck={b.loc[i, cols].to_dict()}")
    return True, f"{len(a)} rows equal"


def run(spark, sf_dir: str, keys=None) -> dict[str, tuple[bool, str]]:
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sp = qs[k](spark, sf_dir).toPandas()
            if k not in sql:
                out[k] = (True, f"rows-only: {len(sp)} rows")
            else:
                dd = con.execute(sql[k]).df()
                out[k] = compare(sp, dd)
        except Exception as e:  # noqa: BLE001
            out[k] = (False, f"error: {type(e).__name__}: {str(e)[:400]}")
        print(f"{'OK ' if out[k][0] else 'BAD'} {k:32s} {time.time() - t0:6.1f}s {out[k][1]}", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tickflow.session import build_session
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": "8g"})
    res = run(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:] or None)
    bad = [k for k, (ok, _) in res.items() if not ok]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
