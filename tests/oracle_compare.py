"""Run a registered Spark query and its DuckDB twin; compare like the driver.

Row count, column names and an order-insensitive hash of the values
(columns sorted by name, floats rounded to 9 significant digits).
"""

from __future__ import annotations

import hashlib
import math
import os

EXACT = os.environ.get("ORACLE_EXACT") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if EXACT else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return digest(df.columns, rows)


def duck_digest(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    rows = rel.fetchall()
    return digest(cols, rows)


def first_diff(df, con, sql, limit=5):
    a = sorted("|".join(_norm(x) for x in r) for r in df.select(sorted(df.columns)).collect())
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    b = sorted("|".join(_norm(r[i]) for i in order) for r in rel.fetchall())
    sa, sb = set(a), set(b)
    return sorted(sa - sb)[:limit], sorted(sb - sa)[:limit]
