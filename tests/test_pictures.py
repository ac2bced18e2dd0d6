"""Resampling and hashes against plain loops; augmentation by counters."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from gleanworks.sources import images


def plain_resize(x, out_h, out_w):
    """One pass a side, pixel by pixel, in Python's whole numbers."""

    def line(values, n):
        scale = len(values) / n
        if len(values) == n:
            return values
        wide, made = max(scale, 1.0), []
        for i in range(n):
            centre = (i + 0.5) * scale
            low, high = max(int(centre - 3 * wide + 0.5), 0), min(int(centre + 3 * wide + 0.5), len(values))
            taps = []
            for k in range(low, high):
                t = (k - centre + 0.5) / wide
                pi = math.pi * t
                taps.append(0.0 if abs(t) >= 3 else 1.0 if t == 0 else 3 * math.sin(pi) * math.sin(pi / 3) / (pi * pi))
            total = sum(taps)
            fixed = [int(t / total * (1 << 22) + (0.5 if t >= 0 else -0.5)) for t in taps]
            made.append(min(255, max(0, (sum(f * int(values[k]) for f, k in zip(fixed, range(low, high))) + (1 << 21)) >> 22)))
        return made

    rows = [line(list(r), out_w) for r in x]
    return np.array([line([r[c] for r in rows], out_h) for c in range(out_w)]).T


def test_resampling_by_loops():
    rnd = np.random.default_rng(4)
    for shape in ((40, 50), (33, 32), (20, 64), (32, 32)):
        x = rnd.integers(0, 256, shape).astype(np.uint8)
        got = images.lanczos_resize(x, 32, 32).astype(int)
        assert np.abs(got - plain_resize(x, 32, 32)).max() <= 1 and (got == plain_resize(x, 32, 32)).mean() > 0.99
    flat = np.full((90, 70), 137, np.uint8)
    assert (images.lanczos_resize(flat, 32, 32) == 137).all()


def test_grey_golden_values():
    x = np.array([[[255, 255, 255], [255, 0, 0], [0, 255, 0], [0, 0, 255], [1, 2, 3], [0, 0, 0]]], np.uint8)
    assert images.grey(x).tolist() == [[255, 76, 150, 29, 2, 0]]


def test_hash_of_known_pictures():
    """Cosine pictures of 32 x 32, whose only frequency besides the mean is known."""
    k = np.arange(32)
    wave = lambda u: np.cos(np.pi * (2 * k + 1) * u / 64)
    for u, v in ((1, 0), (0, 1), (3, 2), (7, 7)):
        plane = 128 + 100 * np.outer(wave(u), wave(v))
        x = np.repeat(np.rint(plane).astype(np.uint8)[:, :, None], 3, 2)
        bits = f"{images.perceptual_hash(x) & (1 << 64) - 1:064b}"
        assert bits[0] == "1" and bits[8 * u + v] == "1"
        small = images.grey(x).astype(float)
        low = [[sum(small[i, j] * math.cos(math.pi * (2 * i + 1) * a / 64) * math.cos(math.pi * (2 * j + 1) * b / 64) for i in range(32) for j in range(32)) for b in range(8)] for a in range(8)]
        middle = sorted(sum(low, []))[31:33]
        assert all(b == str(int(c > sum(middle) / 2)) or abs(c - sum(middle) / 2) < 1e-6 for b, c in zip(bits, sum(low, [])))


def pictures(spark, n=12):
    rnd = random.Random(3)
    rows = [(i, bytearray(rnd.randbytes(3 * 20 * (16 + i))), 20, 16 + i, 3) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, 0, 0, 0), (n + 1, bytearray(b"xy"), 20, 20, 3)], "id long, data binary, height int, width int, channels int")


def test_training_views_depend_on_the_row_alone(spark):
    df = pictures(spark)
    view = lambda d, **k: {r["id"]: r["plane"] for r in images.model_inputs(d, 8, 9, [0.5] * 3, [0.25] * 3, **k).collect()}
    one = view(df, seed=1, epoch=0)
    assert one == view(df.repartition(5).orderBy(F.desc("width")), seed=1, epoch=0) and len(one) == 14
    assert one[12] is None and one[13] is None and all(len(one[i]) == 192 for i in range(12))
    assert all(one[i] != view(df, seed=1, epoch=1)[i] != view(df, seed=2, epoch=1)[i] for i in range(12))
    plain = view(df)
    assert plain == view(df.repartition(3)) and plain[0] != one[0]
    x = images.pixels(bytes(df.where("id = 4").first()["data"]), 20, 20, 3)
    assert plain[4] == images.model_input(x, 8, 9, [0.5] * 3, [0.25] * 3).ravel().tolist()


def test_draws_are_uniform(spark):
    d = spark.range(4000).select(images.augmentation_draws(F.col("id"), 5, 2).alias("d")).select("d.*")
    r = d.agg(*(F.avg(c).alias(c) for c in images.DRAWN), *(F.stddev(c).alias(f"{c}_sd") for c in images.DRAWN), F.corr("scale", "noise").alias("corr")).first()
    assert all(abs(r[c] - 0.5) < 0.02 and abs(r[f"{c}_sd"] - 12**-0.5) < 0.01 for c in images.DRAWN) and abs(r["corr"]) < 0.06
