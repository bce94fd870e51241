"""Compares a query's rows with those of its SQL, values brought to text."""

import datetime
import glob
import os

import duckdb


def text(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.6g}"
    if isinstance(v, datetime.datetime):
        return (v.astimezone(datetime.timezone.utc).replace(tzinfo=None) if v.tzinfo else v).isoformat()
    return str(v)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def differences(spark, con, query, sql, sf_dir):
    """(columns of both, rows only in the query, rows only in the SQL, number of rows)."""
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    ours = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    theirs = sorted(tuple(text(v) for _, v in sorted(zip(names, r))) for r in cur.fetchall())
    if cols != sorted(names):
        return (cols, sorted(names)), [], [], len(ours)
    a, b = set(ours), set(theirs)
    if len(ours) != len(theirs) and a == b:
        return None, [("count", len(ours))], [("count", len(theirs))], len(ours)
    return None, sorted(a - b), sorted(b - a), len(ours)
