"""Comparing a Spark result with a DuckDB result."""

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _kind(series: pd.Series) -> str:
    kind = series.dtype.kind
    return {"i": "integer", "u": "integer", "f": "float", "M": "time", "b": "bool"}.get(kind, "other")


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "M":
            df[c] = pd.to_datetime(df[c]).dt.tz_localize(None).astype("datetime64[us]")
        elif df[c].dtype.kind == "f":
            df[c] = df[c] + 0.0
    text = df.astype(str)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """'' where both hold the same rows, else the first thing that differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for c in want.columns:
        if len(got) and got[c].notna().all() and want[c].notna().all() and _kind(got[c]) != _kind(want[c]):
            return f"column {c}: {got[c].dtype} != {want[c].dtype}"
    a, b = _canonical(got), _canonical(want)
    for c in a.columns:
        bad = a[c] != b[c]
        if bad.any():
            return f"column {c}: {bad.sum()} differ, first {a[bad].iloc[0].to_dict()} != {b[bad].iloc[0].to_dict()}"
    return ""
