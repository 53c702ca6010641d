"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int) and not isinstance(v, bool):
        return int(v)
    return v if isinstance(v, (str, bool)) else str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark_df, con, sql, max_report=5):
    """Return (ok, report)."""
    s_cols, s_rows = rows_of_spark(spark_df)
    d_cols, d_rows = rows_of_duck(con, sql)
    rep = []
    if s_cols != d_cols:
        return False, f"columns differ: spark-only {set(s_cols)-set(d_cols)} duck-only {set(d_cols)-set(s_cols)}"
    if len(s_rows) != len(d_rows):
        rep.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd and not rep:
        return True, f"{len(s_rows)} rows equal"
    only_s = list((cs - cd).elements())[:max_report]
    only_d = list((cd - cs).elements())[:max_report]
    # per-column diagnosis on rows matched by first column
    for a, b in zip(sorted(only_s, key=repr), sorted(only_d, key=repr)):
        diffs = [(c, x, y) for c, x, y in zip(s_cols, a, b) if x != y]
        rep.append(f"diff: {diffs[:6]}")
    rep.append(f"spark-only rows: {len(list((cs - cd).elements()))}, duck-only rows: {len(list((cd - cs).elements()))}")
    return False, "\n".join(rep)
