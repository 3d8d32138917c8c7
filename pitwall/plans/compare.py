"""Local correctness check: run a registered query on Spark and its SQL on DuckDB.

Mirrors the driver's gate: same column names, same row count, order-insensitive
equality of values.  Used by the tests and by hand while developing.
"""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(pdf, cols):
    import pandas as pd

    out = pd.DataFrame(index=range(len(pdf)))
    for c in cols:
        v = pdf[c]
        if v.dtype == object:
            v = v.map(lambda x: None if x is None or x is pd.NA else (repr(x.tolist()) if hasattr(x, "tolist") else x))
        out[c] = v.astype(object).where(v.notna(), None) if v.dtype != object else v
    key = [out[c].map(lambda x: (x is None, str(x))) for c in cols]
    order = pd.DataFrame({i: k for i, k in enumerate(key)}).sort_values(list(range(len(cols)))).index
    return out.loc[order].reset_index(drop=True)


def compare(spark_df, con, sql: str, float_tol: float = 0.0) -> dict:
    """Return a report dict: ok, rows, mismatched columns, first differing rows."""
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    rep = {"spark_rows": len(s), "oracle_rows": len(d), "ok": False}
    if sorted(s.columns) != sorted(d.columns):
        rep["columns"] = {"spark_only": sorted(set(s.columns) - set(d.columns)),
                          "oracle_only": sorted(set(d.columns) - set(s.columns))}
        return rep
    if len(s) != len(d):
        return rep
    cols = sorted(s.columns)
    a, b = _canon(s, cols), _canon(d, cols)
    bad = []
    for c in cols:
        for i, (x, y) in enumerate(zip(a[c], b[c])):
            x, y = _norm(x), _norm(y)
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and abs(x - y) <= float_tol * max(1.0, abs(y)):
                continue
            bad.append((c, i, x, y))
            if len(bad) > 50:
                break
    rep["ok"] = not bad
    rep["diffs"] = bad[:10]
    rep["n_diffs"] = len(bad)
    return rep
