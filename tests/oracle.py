"""Compares a query with its SQL in DuckDB over the same Parquet tables, rows in any order."""

import glob
import os

import duckdb

DATA = os.environ.get("TAGLOOM_TESTDATA", "/root/testdata/sf0.001")


def views():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return [columns[i] for i in order], sorted(tuple(show(r[i]) for i in order) for r in rows)


def assert_same(spark, query, sql):
    df = query(spark, DATA)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    d = views().execute(sql)
    want = normal([x[0] for x in d.description], d.fetchall())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    assert got[1] == want[1]
