"""Compare a Spark result with its SQL twin on DuckDB."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    """Rows with columns in name order, sorted; each value goes with its type's name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    typed = [tuple((type(row[i]).__name__, 0 if row[i] is None else row[i]) for i in order) for row in rows]
    return sorted(typed), [columns[i] for i in order]


def differences(df, con, sql):
    """None when columns and rows agree, else a short description."""
    result = con.execute(sql)
    want, want_columns = sorted_rows([d[0] for d in result.description], result.fetchall())
    got, got_columns = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    pairs = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return f"{len(got)} rows, expected {len(want)}; first differences: {pairs}"


def physical_plan(df):
    """Text of the plan before any adaptive change."""
    fresh = df.select("*")
    return fresh._jdf.queryExecution().executedPlan().toString()
