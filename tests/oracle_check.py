"""Runs queries beside their SQL and compares schema, row count and values."""

import math
import os
import time
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, names in {
        "integer": ("bigint", "int", "integer", "smallint"),
        "text": ("string", "varchar"),
        "double": ("double",),
        "boolean": ("boolean",),
    }.items():
        if name in names:
            return kind
    return name.split("_")[0]


def compare(spark, con, name, query, sql, sf_dir):
    """(problem or None, rows, Spark seconds, DuckDB seconds)."""
    t0 = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    want = result.fetchall()
    t2 = time.time()
    out = (len(got), t1 - t0, t2 - t1)
    if sorted(df.columns) != sorted(columns):
        return (f"columns {sorted(df.columns)} != {sorted(columns)}", *out)
    ours = {c: _kind(k) for c, k in df.dtypes}
    if ours != kinds:
        return (f"types { {c: (ours[c], kinds[c]) for c in ours if ours[c] != kinds[c]} }", *out)
    if len(got) != len(want):
        return (f"{len(got)} rows != {len(want)}", *out)
    a, b = _rows(df.columns, got), _rows(columns, want)
    if a != b:
        first = next((x, y) for x, y in zip(a, b) if x != y)
        n = sum(x != y for x, y in zip(a, b))
        return (f"{n} rows differ, first {str(first)[:1500]}", *out)
    return (None, *out)
