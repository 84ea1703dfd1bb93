"""Side-by-side comparison of a Spark result and the SQL that checks it."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float):
        return v + 0.0
    return v


def mismatch(spark_df, con, sql: str) -> str | None:
    """A description of the first difference, or None; floats must agree to the last rounded digit."""
    names = sorted(spark_df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in names) for r in spark_df.collect()), key=_key)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}"
    order = [cols.index(c) for c in names]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, first: {diff[:4]}"
    return None
