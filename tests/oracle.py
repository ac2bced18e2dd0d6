"""Runs a query and its oracle SQL on the same tables and compares all rows; null and NaN are told apart."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return "NaN" if v != v else f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def check(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    got, want = query(spark, sf_dir), con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    columns = sorted(names)
    a = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    b = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())
    assert a == b
