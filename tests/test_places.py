"""Places in an order, draws with replacement and threshold bins."""

import random

import pytest
from pyspark.sql import functions as F

from gleanworks.operators import evaluation as ev
from gleanworks.operators import places
from gleanworks.operators import sampling as sa


@pytest.mark.parametrize("piece", [7, 10**6])
def test_places_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(places, "PIECE", piece)
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "a", "a", "b"]), rnd.choice([None, 1, 1, 1, 2]), i) for i in range(90)]  # tied scores, a large group
    df = spark.createDataFrame(rows, "g string, s int, id int").repartition(5)
    low = lambda x: (x is not None, x or 0)
    want = {}
    for g in (None, "a", "b"):
        for at, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (low(r[1]), r[2]))):
            want[r[2]] = at
    found = places.placed(df, ["g"], ["s", "id"])
    assert {r["id"]: r["place"] for r in found.collect()} == want
    whole = places.placed(df, [], [F.col("s").asc_nulls_last(), "id"])
    assert [r["id"] for r in whole.orderBy("place").collect()] == [r[2] for r in sorted(rows, key=lambda r: (r[1] is None, r[1], r[2]))]
    assert places.placed(df.limit(0), [], ["s"]).count() == 0


def test_draws(spark, monkeypatch):
    df = spark.range(600).select("id", F.when(F.col("id") < 540, "many").when(F.col("id") < 590, "some").alias("c"), F.lit("mine").alias("_place"))
    runs = []
    for n in (1, 7):
        runs.append({r["id"]: (r["c"], r["copies"]) for r in sa.drawn_copies(df.repartition(n), "c", "id", 3).collect()})
    monkeypatch.setattr(places, "PIECE", 50)
    runs.append({r["id"]: (r["c"], r["copies"]) for r in sa.drawn_copies(df, "c", "id", 3).collect()})
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 600
    by = {c: sum(n for k, n in runs[0].values() if k == c) for c in ("many", "some", None)}
    assert sum(by.values()) == 600 and all(150 < n < 250 for n in by.values())
    copies = [n for k, n in runs[0].values() if k == "some"]
    assert max(copies) > 4 and len(set(copies)) > 4  # drawn, not dealt evenly
    assert sa.drawn_copies(df.limit(0), "c", "id", 3).count() == 0
    totals = [sum(r["copies"] for r in sa.drawn_copies(df, "c", "id", seed).where("c IS NULL").collect()) for seed in range(6)]
    assert 150 < sum(totals) / 6 < 250 and len(set(totals)) > 1


def test_bins_at_their_bounds(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("a", 0.2, 2), ("a", None, 4), ("b", 0.3, 8), ("c", None, 16)], "g string, s double, w int")
    got = {(r["g"], r["t"]): (r["n"], r["n_all"], r["w"], r["w_all"]) for r in ev.reached(df, "s", [0.2, 0.1, 0.2], {"w": F.sum("w")}, ["g"]).collect()}
    assert got == {("a", 0.1): (2, 2, 3, 3), ("a", 0.2): (1, 2, 2, 3), ("b", 0.1): (1, 1, 8, 8), ("b", 0.2): (1, 1, 8, 8), ("c", 0.1): (0, 0, None, None), ("c", 0.2): (0, 0, None, None)}
    plan = ev.threshold_curve(spark.createDataFrame([(0.5, 1, [1])], "conf double, y int, ord array<int>"), [0.2])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
