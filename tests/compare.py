"""Order-free comparison of a Spark result with a DuckDB result."""

import glob
import os

import duckdb
import numpy as np


def connect(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def canonical(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)

    def text(v):
        if v is None or v != v:
            return "~"
        return repr(float(v)) if isinstance(v, (int, float, np.number)) else str(v)

    df = df.astype(object).where(df.notna(), None).map(text)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def same(a, b):
    """None when equal, else what differs."""
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} and {sorted(b.columns)}"
    x, y = canonical(a), canonical(b)
    if len(x) != len(y):
        return f"{len(x)} and {len(y)} rows"
    if not x.equals(y):
        off = (x != y).any(axis=1)
        return f"{int(off.sum())} rows differ\n{x[off].head(3)}\n{y[off].head(3)}"
    return None
