"""Run a registered query in Spark and its oracle in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r)
    )


def compare(df, con, sql):
    """(equal, message, row count)"""
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.toLocalIterator()])
    if want_cols != got_cols:
        return False, f"columns {got_cols} != {want_cols}", len(got)
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}", len(got)
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return False, f"first difference\n  got  {g}\n  want {w}\n  {want_cols}", len(got)
    return True, "equal", len(got)
