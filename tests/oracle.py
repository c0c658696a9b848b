"""Runs a query on Spark and its SQL twin on DuckDB and compares the rows."""
from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(repr(v))
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(names, cur.fetchall())
    if a == b:
        kinds = dict(zip(names, (str(d[1]) for d in cur.description)))
        return True, f"{sum(a.values())} rows, types {[(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema]}"
    only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
    return False, f"rows {sum(a.values())} vs {sum(b.values())}; spark only {only_a}; sql only {only_b}"
