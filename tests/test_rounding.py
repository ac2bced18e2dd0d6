"""Rounding as the SQL rounds, at halves in binary too."""

import random

import duckdb
from pyspark.sql import functions as F

from gleanworks.functions.arrays import rounded


def test_rounded_as_in_sql(spark):
    rnd = random.Random(4)
    # 1.0000000005 scaled by 1e9 is a half in binary, but not in its decimal text, and so on.
    halves = [s * (k + 0.5) / 1e9 for k in rnd.sample(range(3 * 10**9), 2000) for s in (1, -1)]
    values = [1.0000000005, -0.2e-10, 0.0, -0.0, 2.5, -2.5, 1e300, -1e305, float("inf"), float("-inf"), None, 2.0**53 + 1, *halves, *(rnd.uniform(-3, 3) for _ in range(2000))]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").repartition(2)
    for digits in (9, 6, 4):
        want = con.execute(f"SELECT i, round(x, {digits}) FROM t ORDER BY i").fetchall()
        got = df.select("i", rounded(F.col("x"), digits).alias("r")).orderBy("i").collect()
        assert [(r["i"], repr(r["r"])) for r in got] == [(i, repr(x)) for i, x in want]
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(rounded(F.col("x"), 9).alias("r")).first()["r"]
    assert nan != nan
