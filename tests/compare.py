"""Spark and DuckDB answers side by side, order ignored."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text of its exact value, rows sorted."""
    frame = frame[sorted(frame.columns)]

    def show(v) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
            return str(bool(v))
        if hasattr(v, "isoformat"):
            text = v.isoformat()
            return text if "T" in text else f"{text}T00:00:00"
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v))
        return str(v)

    shown = pd.DataFrame({c: [show(v) for v in frame[c].tolist()] for c in frame.columns})
    return shown.sort_values(list(shown.columns), ignore_index=True) if len(shown.columns) else shown


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the answers agree, else a short account."""
    table = con.sql(sql).to_arrow_table()
    ours = spark_df.toArrow()
    if sorted(ours.column_names) != sorted(table.column_names):
        return f"columns {sorted(ours.column_names)} / {sorted(table.column_names)}"
    types = {c: (str(ours.schema.field(c).type), str(table.schema.field(c).type)) for c in ours.column_names}
    # bool, text, time and number must not be mixed up between the two.
    def family(t: str) -> str:
        for word in ("bool", "string", "timestamp", "date", "double", "decimal", "int"):
            if word in t:
                return word
        return t
    odd = {c: t for c, t in types.items() if family(t[0]) != family(t[1])}
    if odd:
        return f"types {odd}"
    a = canonical(pd.DataFrame(ours.to_pydict()))
    b = canonical(pd.DataFrame(table.to_pydict()))
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    if len(a) == 0:
        return "both empty"
    if a.equals(b):
        return None
    bad = (a != b).any(axis=1)
    return f"{int(bad.sum())} rows differ, first:\n{a[bad].head(3)}\n{b[bad].head(3)}"
