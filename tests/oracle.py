"""Run a query and its SQL over the same tables and compare them, as the driver does."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, list):
        return [norm(x) for x in v]
    return v


def compare(spark_rows, spark_cols, con, sql: str) -> tuple[int, list]:
    """Rows, and up to 3 differing rows of each side."""
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(spark_cols), (sorted(cols), sorted(spark_cols))
    want = sorted(repr([norm(r[cols.index(c)]) for c in sorted(cols)]) for r in rel.fetchall())
    got = sorted(repr([norm(r[spark_cols.index(c)]) for c in sorted(cols)]) for r in spark_rows)
    if want == got:
        return len(want), []
    from collections import Counter

    a, b = Counter(got), Counter(want)
    return len(got), [list((a - b).elements())[:3], list((b - a).elements())[:3], len(want)]
