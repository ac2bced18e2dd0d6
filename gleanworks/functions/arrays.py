"""Array expressions over probability and logit vectors; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def rounded(x: Column, digits: int) -> Column:
    """A double at `digits` decimals as the SQL rounds it: scaled, halves away from zero, scaled back, all in binary.

    Spark's round works on the shortest decimal text instead; the two differ where scaling meets a half."""
    unit = 10.0**digits

    def scaled(v: Column) -> Column:
        y = v * unit
        whole = F.round(y)
        # A zero keeps its sign; what scaling makes infinite stays as it is.
        return F.when(F.abs(y) < float("inf"), F.when(whole == 0, y * 0.0).otherwise(whole) / unit).otherwise(v)

    return bound(x, scaled)


def softmax(z: Column) -> Column:
    """exp(x - max) / sum over an array<double>; computed in double, each exponential once."""
    powers = bound(F.struct(z.alias("z"), F.array_max(z).alias("top")), lambda s: F.transform(s["z"], lambda x: F.exp(x - s["top"])))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    summed = bound(powers, lambda e: F.struct(e.alias("e"), total(e).alias("total")))
    return bound(summed, lambda s: F.transform(s["e"], lambda x: x / s["total"]))


def ranked_classes(p: Column) -> Column:
    """Class indices by probability descending; equal probabilities by lower index."""
    pairs = F.transform(p, lambda x, i: F.struct((-x).alias("neg"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda s: s["i"])


def argmax(p: Column) -> Column:
    """First index of the maximum."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def group_sum(p: Column, ids: list[int]) -> Column:
    """Sum of the entries whose index is in ids."""
    kept = F.filter(p, lambda x, i: i.isin(ids))
    return F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)


def largest_difference(a: Column, b: Column) -> Column:
    """max |a - b| over two arrays of one length; NaN where their lengths differ, null for a null array."""
    apart = F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    return F.when(F.size(a) == F.size(b), apart).when(a.isNotNull() & b.isNotNull(), F.lit(float("nan")))


def normalised(x: Column, mean: Column, spread: Column) -> Column:
    """(x - 255 mean) / (255 spread) for each element of a flat plane."""
    return F.transform(x, lambda v: (v - mean * 255) * (1 / (spread * 255)))
