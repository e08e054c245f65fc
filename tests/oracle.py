"""Compare a registered query with its SQL the way the gate does: schema, row count, values in any order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].astype(object).where(df[c].notna(), None)
    keys = df.map(lambda v: "~" if v is None else repr(v))
    return df.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True) if len(df) else df.reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame, tol: float = 0.0) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        bad = [i for i, (x, y) in enumerate(zip(a[c], b[c])) if x != y and not (
            isinstance(x, float) and isinstance(y, float) and abs(x - y) <= tol)]
        if bad:
            return f"{c}: {len(bad)} differ, first {a.loc[bad[0]].to_dict()} vs {b.loc[bad[0]].to_dict()}"
    return None
