"""Run a query's DuckDB text over a folder of tables and compare values, whatever the order."""

import glob
import os

import duckdb


def rows_of(sql, folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        inside = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{inside}'")
    got = con.sql(sql)
    return list(got.columns), got.fetchall()


def _plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return tuple(map(_plain, x)) if isinstance(x, list) else x


def assert_same(frame, sql, folder):
    names, want = rows_of(sql, folder)
    assert sorted(names) == sorted(frame.columns)
    order = sorted(names)
    got = sorted((tuple(_plain(r[n]) for n in order) for r in frame.collect()), key=repr)
    want = sorted((tuple(_plain(r[names.index(n)]) for n in order) for r in want), key=repr)
    assert len(got) == len(want)
    assert got == want
