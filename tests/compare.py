"""Rows of a query against the rows of its SQL in DuckDB."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.12g}")
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    return x


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([plain(v[i]) for i in order] for v in values), key=repr)


def compare(spark, con, sf_dir, run, sql):
    df = run(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.sql(sql)
    want = rows(found.columns, found.fetchall())
    kinds = {n: (t, str(k)) for n, t, k in zip(sorted(df.columns), [dict(df.dtypes)[c] for c in sorted(df.columns)], [dict(zip(found.columns, found.types, strict=True))[c] if c in found.columns else None for c in sorted(df.columns)], strict=True)}
    return got, want, kinds
