"""A query against its DuckDB oracle on given tables."""

import math

import duckdb


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 9) if isinstance(v, float) else v


def compare(df, sql, tables):
    """``tables``: name -> parquet path."""
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted((tuple(_norm(r[columns.index(c)]) for c in sorted(columns)) for r in res.fetchall()), key=repr)
    got = sorted((tuple(_norm(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr)
    assert got == want
    return got
