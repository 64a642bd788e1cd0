"""Compares a query with its SQL the way of a value hash: columns by name, rows in any order."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(con, sql, df):
    rel = con.execute(sql)
    want = normal([d[0] for d in rel.description], rel.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return ""
    a, b = set(map(repr, got[1])), set(map(repr, want[1]))
    return f"columns {got[0]} {want[0]}; rows {len(got[1])} {len(want[1])}; only here {sorted(a - b)[:3]}; only in SQL {sorted(b - a)[:3]}"
