"""Compare a Spark result with DuckDB running the oracle SQL on the same
Parquet files: column names, row count, types and order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tempora.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v, places=None):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, places)) if places is not None else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "NULL"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dt.timedelta):
        return str(v.total_seconds())
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x, places) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x, places)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def _rows(cols, tuples, places=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i], places) for i in order) for r in tuples)


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols),
           "spark_cols": s_cols, "oracle_cols": d_cols,
           "spark_types": [f.dataType.simpleString() for f in spark_df.schema.fields],
           "oracle_types": d_types}
    out["exact"] = out["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    by = [d_cols.index(c) for c in s_cols] if out["columns_match"] else []
    out["ordered"] = out["columns_match"] and [tuple(map(_canon, r)) for r in s_rows] == [
        tuple(_canon(r[i]) for i in by) for r in d_rows]
    out["approx"] = out["columns_match"] and _rows(s_cols, s_rows, 6) == _rows(d_cols, d_rows, 6)
    if not out["approx"] and out["columns_match"]:
        a, b = _rows(s_cols, s_rows, 6), _rows(d_cols, d_rows, 6)
        out["only_spark"] = [r for r in a if r not in set(b)][:3]
        out["only_oracle"] = [r for r in b if r not in set(a)][:3]
    return out
