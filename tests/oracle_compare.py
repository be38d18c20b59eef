"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows once columns are sorted by name.
"""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    if len(sr) != len(dr):
        problems.append(f"rows {len(sr)} != {len(dr)}")
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return len(sr), problems
