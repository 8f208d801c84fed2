"""Run a named query on Spark and its oracle on DuckDB, compare the results.

Order-insensitive: columns are sorted by name, rows are sorted, floats are
compared after rounding to 6 decimals and timestamps as text.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from ..sources.tables import GIVEN_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in GIVEN_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(x) for x in rec))
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, rows


SPARK_TYPES = {"bigint": "int64", "int": "int32", "double": "float64", "string": "str", "boolean": "bool",
               "timestamp_ntz": "ts", "timestamp": "ts", "date": "date"}
DUCK_TYPES = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
              "TIMESTAMP": "ts", "DATE": "date"}


def compare(spark, name: str, query_fn, sql: str, sf_dir: str, con=None) -> dict:
    sdf = query_fn(spark, sf_dir)
    left = sdf.toPandas()
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    right = rel.df()
    st = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    lc, lr = _rows(left)
    rc, rr = _rows(right)
    res = {"name": name, "spark_rows": len(lr), "oracle_rows": len(rr),
           "columns_match": lc == rc, "types_match": st == dt, "values_match": False, "diff": None}
    if st != dt:
        res["type_diff"] = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if lc != rc:
        res["diff"] = f"columns spark={lc} oracle={rc}"
        return res
    if lr == rr:
        res["values_match"] = True
        return res
    sl, sr = set(lr), set(rr)
    res["diff"] = {"only_spark": sorted(sl - sr, key=str)[:5], "only_oracle": sorted(sr - sl, key=str)[:5]}
    return res
