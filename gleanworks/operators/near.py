"""Near 64-bit fingerprints: pairs within a Hamming distance, and leader groups by rounds.

Pairs are found exactly in one of two ways, whichever costs less at the table's size. By bands: a
fingerprint is cut into bands, and of two that differ in `most` bits some band differs in at most
its radius; each side is dealt to all band values within half of it, so that two rows meet half way, and a pair is
emitted only at one such value of its first such band. By blocks: rows are packed into blocks and each pair of
blocks i <= j is compared as arrays in one task.

Leader groups (in order of id a row joins the least leader within `most` bits, else leads) are the
greedy independent set of those pairs, so they need no class in one task: equal fingerprints stand for one
another, rows near a leader of earlier ids are settled by a join with the leaders alone, and among the
rest a row without an unsettled earlier neighbour leads, which settles its neighbours. Once few pairs
of a class are left, one task walks them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.session import durable

BITS, BLOCK = 64, 2048
#: What a comparison in a block costs against a dealt row.
COMPARED = 0.005
#: What a pair met at a value of a band costs against a dealt row.
MET = 0.05
#: Pairs of a class that one task walks, 16 bytes each; beyond, rounds go on.
WALKED = 200_000
#: Rows (of different fingerprint) settled at first, and how much more each time.
FIRST, GROWTH = 1 << 18, 16


def bands(most: int, n: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the cheapest cut into bands for n rows; the radii and their number add up to more than `most`."""

    def cut(m: int) -> list[tuple[int, int, int]]:
        width, radius = [BITS // m + (i < BITS % m) for i in range(m)], max(0, most + 1 - m)
        return [(sum(width[:i]), width[i], radius // m + (i < radius % m)) for i in range(m)]

    return min((cut(m) for m in range(1, min(16, most + 1) + 1)), key=lambda c: _cost(c, n))


def _probes(width: int, radius: int) -> int:
    return sum(math.comb(width, k) for k in range(radius + 1))


def _cost(cut: list[tuple[int, int, int]], n: int) -> float:
    """Rows dealt and pairs met for each row; both rows of a pair are dealt half way, where it meets at a few values."""
    return sum(sum(_probes(w, far) for far in _halves(r)) + MET * _probes(w, _halves(r)[0]) * _probes(w, _halves(r)[1]) * n / 2**w for _, w, r in cut)


def near(left: DataFrame, right: DataFrame | None, most: int, same: bool) -> DataFrame:
    """(key, a, b, distance) of rows (key, id, h) within `most` bits: from left and right, or without right of left's own, a < b.

    same: of one key, else of different ones (key is then left's). No column is null."""
    n = left.count() if right is None else max(left.count(), right.count())
    cut = bands(most, n)
    way = _by_bands if _cost(cut, n) < COMPARED * n and max(_probes(w, _halves(r)[1]) for _, w, r in cut) < 20_000 else _by_blocks
    return way(left, right, most, same, cut)


def _halves(radius: int) -> tuple[int, int]:
    """How far left's and right's rows are dealt in a band: as far as each other, so that they meet half way."""
    return radius // 2, radius - radius // 2


def _dealt(df: DataFrame, cut: list, side: int) -> DataFrame:
    """(key, id, h, cell): a row to all values of each band within this side's share of its radius."""
    out = None
    for i, (shift, width, radius) in enumerate(cut):
        # A band's flips are one literal, so the plan does not grow with them.
        flips = F.lit([sum(1 << b for b in bits) for k in range(_halves(radius)[side] + 1) for bits in itertools.combinations(range(width), k)]).cast("array<long>")
        own = df.select("key", "id", "h", F.explode(flips).alias("flip")).select("key", "id", "h", _cell(_part(F.col("h"), shift, width).bitwiseXOR(F.col("flip")), i).alias("cell"))
        out = own if out is None else out.unionByName(own)
    return out


def _cell(part: Column, band: int) -> Column:
    """A band and its value in one number: of several bands none is wider than 32 bits."""
    return part.bitwiseOR(F.lit(band << 32).cast("long"))


def _part(h: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1).cast("long"))


def _by_bands(left: DataFrame, right: DataFrame | None, most: int, same: bool, cut: list) -> DataFrame:
    ones = _dealt(left, cut, 0).select(F.col("key").alias("key1"), F.col("id").alias("a"), F.col("h").alias("h1"), "cell")
    both = F.col("h1").bitwiseXOR(F.col("h"))
    # Two rows meet at several values half way and in several bands; one of them is theirs.
    meets = F.lit(False)
    for i, (s, w, r) in reversed(list(enumerate(cut))):
        apart, far = _part(both, s, w), _halves(r)
        rest = apart
        for _ in range(far[0]):
            rest = rest.bitwiseAND(rest - 1)
        # Left flips the lowest bits that differ, as many as it is dealt to, and right the others.
        at = _part(F.col("h"), s, w).bitwiseXOR(rest)
        meets = F.when(F.bit_count(apart) <= r, F.col("cell") == _cell(at, i)).otherwise(meets)
    # Statistics do not know how many rows are dealt, so a broadcast would be taken for small.
    met = ones.join(_dealt(left if right is None else right, cut, 1).hint("merge"), "cell").where(F.bit_count(both) <= most)
    met = met.where(F.col("key1") == F.col("key") if same else F.col("key1") != F.col("key"))
    if right is None:
        met = met.where("a < id")
    return met.where(meets).select(F.col("key1").alias("key"), "a", F.col("id").alias("b"), F.bit_count(both).alias("distance"))


def _by_blocks(left: DataFrame, right: DataFrame | None, most: int, same: bool, cut: list) -> DataFrame:
    """A row goes to the pairs of its block only; a pair of blocks is one row of two arrays."""
    group = F.col("key") if same else F.lit("")

    def packed(df: DataFrame) -> DataFrame:
        rows = df.withColumn("grp", group)
        n = rows.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
        rows = rows.join(n, "grp").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
        return rows.groupBy("grp", "own", "n").agg(F.collect_list(F.struct("key", "id", "h")).alias("rows"))

    # A block is read again for each block that it meets, so it is written once.
    one = durable(packed(left))
    two = one if right is None else durable(packed(right))
    spots = one.select("grp", F.col("own").alias("i"), F.lit(0).alias("one")).join(two.select("grp", F.col("own").alias("j"), F.lit(0).alias("two")), "grp")
    spots = spots.where("i <= j" if right is None else "true").select("grp", "i", "j")
    pairs = spots.join(one.select("grp", F.col("own").alias("i"), F.col("rows").alias("one")), ["grp", "i"]).join(two.select("grp", F.col("own").alias("j"), F.col("rows").alias("two")), ["grp", "j"])
    own = right is None
    kind = dict(left.dtypes)["key"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(len(batch)):
                lists = [batch.column(c).slice(x, 1).flatten() for c in ("one", "two")]
                keys = [r.field("key") for r in lists]
                codes, _ = pd.factorize(np.concatenate([k.to_pandas().to_numpy() for k in keys]))
                codes = codes[: len(lists[0])], codes[len(lists[0]) :]
                ids = [r.field("id").to_numpy() for r in lists]
                hashes = [r.field("h").to_numpy().view(np.uint64) for r in lists]
                diagonal = own and batch.column("i")[x].as_py() == batch.column("j")[x].as_py()
                for at in range(0, len(ids[0]), 256):
                    rows = slice(at, at + 256)
                    distance = np.bitwise_count(hashes[0][rows, None] ^ hashes[1][None, :])
                    good = (distance <= most) & ((codes[0][rows, None] == codes[1][None, :]) == same)
                    if diagonal:
                        good &= ids[0][rows, None] < ids[1][None, :]
                    i, j = np.nonzero(good)
                    a, b, k = ids[0][rows][i], ids[1][j], keys[0].slice(at, 256).take(pa.array(i))
                    if own:
                        other = keys[1].take(pa.array(j))
                        swap = a > b
                        k = k if same else pc.if_else(pa.array(swap), other, k)
                        a, b = np.minimum(a, b), np.maximum(a, b)
                    if len(a):
                        yield pa.RecordBatch.from_arrays([k, pa.array(a), pa.array(b), pa.array(distance[i, j].astype(np.int32))], ["key", "a", "b", "distance"])

    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism
    met = pairs.repartition(tasks, "i", "j", "grp").mapInArrow(compare, f"key {kind}, a long, b long, distance int")
    return met.where("a < b") if own else met


def hamming_pairs(df: DataFrame, most: int) -> DataFrame:
    """(a, b, distance): rows of different class whose fingerprints h differ in at most `most` bits, a < b. Nulls take no part."""
    # Fingerprints may be costly, and rows are counted before they meet.
    rows = durable(df.select(F.col("class").alias("key"), "id", "h").where("id IS NOT NULL AND key IS NOT NULL AND h IS NOT NULL"))
    return near(rows, None, most, False).select("a", "b", "distance")


def _followers(pairs: DataFrame) -> DataFrame:
    """(key, b): the rows of pairs (key, a, b), a < b, that some leader is near."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        follow = set()
        for a, b in pdf.sort_values(["b", "a"])[["a", "b"]].itertuples(index=False):
            if a not in follow:
                follow.add(b)
        return pd.DataFrame({"key": pdf["key"].iloc[0], "b": sorted(follow)})

    kind = dict(pairs.dtypes)["key"]
    left, found = pairs.select("key", "a", "b"), []
    while True:
        # A row a class.
        many = left.groupBy("key").agg((F.count("*") > WALKED).alias("many"))
        sizes = {r["many"] for r in many.select("many").distinct().collect()}
        cut = left.join(many, "key")
        if False in sizes:
            found.append(cut.where("NOT many").select("key", "a", "b").groupBy("key").applyInPandas(walk, f"key {kind}, b long"))
        if True not in sizes:
            break
        left = cut.where("many").select("key", "a", "b")
        heads = left.select("key", "a").distinct().join(left.select("key", F.col("b").alias("a")).distinct(), ["key", "a"], "left_anti")
        settled = durable(left.join(heads, ["key", "a"]).select("key", "b").distinct())
        found.append(settled)
        left = left.join(settled, ["key", "b"], "left_anti").join(settled.withColumnRenamed("b", "a"), ["key", "a"], "left_anti")
        left = durable(left.select("key", "a", "b"))
    out = found[0] if found else pairs.select("key", "b").limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def leader_clusters(df: DataFrame, most: int) -> DataFrame:
    """(class, id, leader): in order of id a row joins the least leader within `most` bits in its class, else leads.

    A null class is a class; a row without a fingerprint leads alone. Equal to the walk over each class in order, whatever the partitions."""
    named = durable(df.select("class", "id", "h", F.to_json(F.struct("class")).alias("key")))
    prints = durable(named.where("h IS NOT NULL").groupBy("key", "h").agg(F.min("id").alias("id")))
    n, sizes = prints.count(), []
    while n > FIRST * GROWTH ** len(sizes):
        sizes.append(FIRST * GROWTH ** len(sizes) / n)
    cuts = sorted(set(prints.approxQuantile("id", sizes, 0.001))) if sizes else []
    leaders, follow = None, []
    for low, high in zip([None, *cuts], [*cuts, None]):
        rest = prints if low is None else prints.where(F.col("id") > low)
        rest = rest if high is None else rest.where(F.col("id") <= high)
        if leaders is not None:
            joined = durable(near(leaders, rest, most, True).groupBy("key", F.col("b").alias("id")).agg(F.min("a").alias("leader")))
            follow.append(joined)
            rest = durable(rest.join(joined, ["key", "id"], "left_anti"))
        pairs = durable(near(rest, None, most, True))
        late = durable(_followers(pairs))
        heads = pairs.join(late, ["key", "b"]).join(late.withColumnRenamed("b", "a"), ["key", "a"], "left_anti")
        follow.append(durable(heads.groupBy("key", F.col("b").alias("id")).agg(F.min("a").alias("leader"))))
        new = rest.join(follow[-1], ["key", "id"], "left_anti").select("key", "id", "h")
        leaders = durable(new if leaders is None else leaders.unionByName(new))
    led = follow[0]
    for more in follow[1:]:
        led = led.unionByName(more)
    of = prints.join(led, ["key", "id"], "left").select("key", "h", F.coalesce("leader", "id").alias("leader"))
    return named.join(of, ["key", "h"], "left").select("class", "id", F.coalesce("leader", "id").alias("leader"))
