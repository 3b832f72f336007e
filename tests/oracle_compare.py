"""Compare a Spark query with its DuckDB oracle: rows, column names and an
order-insensitive hash of the values (floats rounded to 6 decimals)."""

from __future__ import annotations

import hashlib
import math

import duckdb

from shroud.sources.fixture import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
          "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "rows": (len(s_rows), len(d_rows)),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    s_types = {c: _TYPES.get(t, t) for c, t in sdf.dtypes}
    d_types = {d[0]: str(d[1]) for d in res.description}
    out["type_diff"] = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    out["hash_match"] = hs == hd
    if not (out["cols_match"] and out["hash_match"]):
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
        only_s = sorted(set(ls) - set(ld))[:5]
        only_d = sorted(set(ld) - set(ls))[:5]
        out["only_spark"], out["only_duck"] = only_s, only_d
    return out
