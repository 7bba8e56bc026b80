"""Run a query's DuckDB text over a folder of tables and compare values, whatever the order."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else x


def differences(frame, sql, con):
    got = con.sql(sql)
    names, want = list(got.columns), got.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    order = sorted(names)
    mine = sorted((tuple(plain(r[n]) for n in order) for r in frame.collect()), key=repr)
    theirs = sorted((tuple(plain(r[names.index(n)]) for n in order) for r in want), key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)}"
    odd = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(odd)} rows differ: {odd[:3]}" if odd else ""
