"""Spark-vs-DuckDB comparison used by the tests (mirrors the correctness gate).

Row count, column names and an order-insensitive multiset of row values must
agree.  Floats are compared after rounding to 9 significant digits.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sv = canon(s_cols, s_rows)
    dc, dv = canon(d_cols, d_rows)
    return {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sc == dc, "values_match": sv == dv,
        "spark_only": list((sv - dv).items())[:3], "oracle_only": list((dv - sv).items())[:3],
        "cols": (sc, dc) if sc != dc else None,
    }
