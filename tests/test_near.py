"""Near fingerprints and leader groups against plain loops."""

import random

import pytest

from gleanworks.operators import near


def frame(spark, rows):
    return spark.createDataFrame([(c, i, None if h is None else h - (h >> 63 << 64)) for c, i, h in rows], "class string, id long, h long")


def scattered(seed, n, flips):
    """Rows of a few classes, near some of 12 centres; ids in random order of class."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(12)]
    ids = rnd.sample(range(10 * n), n)
    return [(rnd.choice(["a", "a", "b", None]), i, rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(flips)))) for i in ids]


def walked(rows, most):
    heads, out = {}, {}
    for c, i, h in sorted(rows, key=lambda r: r[1]):
        own = heads.setdefault(c, [])
        out[c, i] = next((k for k, x in own if (x ^ h).bit_count() <= most), i)
        if out[c, i] == i:
            own.append((i, h))
    return out


@pytest.mark.parametrize("seed", (0, 1, 5, 6))
def test_leaders_as_walked_in_order(spark, monkeypatch, seed):
    """Each way on its own: one task a class, rounds alone, growing parts, bands and blocks."""
    monkeypatch.setattr(near, "WALKED", (200_000, 0, 40, 0)[seed % 4])
    if seed > 3:
        monkeypatch.setattr(near, "FIRST", 15)
        monkeypatch.setattr(near, "GROWTH", 4)
    if seed % 2:
        monkeypatch.setattr(near, "COMPARED", 1e9)
    rows = scattered(seed, 80, 7)
    most = 3 if seed == 1 else 7 if seed % 2 else 20
    got = {(r["class"], r["id"]): r["leader"] for r in near.leader_clusters(frame(spark, rows).repartition(3), most).collect()}
    assert got == walked(rows, most)


def test_leader_cases(spark, monkeypatch):
    monkeypatch.setattr(near, "WALKED", 0)
    chain = [("c", i, (1 << i) - 1) for i in range(8)]  # each near the ones beside it
    got = {r["id"]: r["leader"] for r in near.leader_clusters(frame(spark, chain), 1).collect()}
    assert got == {i: i - i % 2 for i in range(8)}
    copies = [("c", i, 5) for i in range(300)] + [("c", 300, None), ("c", 301, None), (None, 302, 5), (None, 303, 7)]
    got = {r["id"]: r["leader"] for r in near.leader_clusters(frame(spark, copies), 1).collect()}
    assert got == {**dict.fromkeys(range(300), 0), 300: 300, 301: 301, 302: 302, 303: 302}
    assert near.leader_clusters(frame(spark, []), 1).count() == 0


@pytest.mark.parametrize("most", (0, 5, 9))
def test_bands_meet_each_near_pair_once(spark, monkeypatch, most):
    monkeypatch.setattr(near, "COMPARED", 1e9)
    rows = [(c, i, h) for c, i, h in scattered(most, 200, 9) if c]
    want = sorted((a, b, (x ^ y).bit_count()) for ca, a, x in rows for cb, b, y in rows if a < b and ca != cb and (x ^ y).bit_count() <= most)
    df = near.hamming_pairs(frame(spark, rows), most)
    assert sorted(map(tuple, df.collect())) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_band_cuts_are_exact():
    """Radii and their number exceed the distance, so some band is within its radius (pigeonhole)."""
    for most in range(64):
        for n in (10, 10**6, 10**9):
            cut = near.bands(most, n)
            assert sum(r + 1 for _, _, r in cut) > most and sum(w for _, w, _ in cut) == 64
            assert [s for s, _, _ in cut] == [sum(w for _, w, _ in cut[:i]) for i in range(len(cut))]


def test_blocks_of_several(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    rows = [(c, i, h) for c, i, h in scattered(3, 120, 9) if c]
    want = sorted((a, b, (x ^ y).bit_count()) for ca, a, x in rows for cb, b, y in rows if a < b and ca != cb and (x ^ y).bit_count() <= 24)
    assert sorted(map(tuple, near.hamming_pairs(frame(spark, rows), 24).collect())) == want


def test_rows_meet_half_way(spark):
    """A row is dealt to the values within half of a band's radius, not within all of it, and meets each near row once."""
    rnd = random.Random(8)
    heads = [rnd.getrandbits(64) for _ in range(30)]
    rows = [("ab"[i % 2], i, heads[i % 30] ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6)))) for i in range(240)]
    want = sorted((a, b, (x ^ y).bit_count()) for ca, a, x in rows for cb, b, y in rows if a < b and ca != cb and (x ^ y).bit_count() <= 8)
    df = frame(spark, [(c, i, h) for c, i, h in rows]).withColumnRenamed("class", "key")
    for cut in ([(0, 22, 2), (22, 21, 2), (43, 21, 2)], [(0, 32, 3), (32, 32, 4)], [(0, 16, 2), (16, 16, 1), (32, 16, 1), (48, 16, 1)]):
        met = near._by_bands(df, None, 8, False, cut)
        assert sorted(tuple(r)[1:] for r in met.collect()) == want
        assert near._dealt(df, cut, 0).count() == len(rows) * sum(near._probes(w, r // 2) for _, w, r in cut)
    assert [(w, r) for _, w, r in near.bands(8, 7_200_000)] == [(22, 2), (21, 2), (21, 2)]
