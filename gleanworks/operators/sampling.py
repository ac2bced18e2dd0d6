"""Samples and picks: seeded heads and subsets, even picks, balanced replicates, reference rows, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.operators.places import placed


def seeded_key(seed: int, *keys: str) -> Column:
    """A 32-bit number by seed and keys, the same on every engine that has MD5; the order of a seeded shuffle."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def seeded_head(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """The first n rows of a seeded shuffle; a bounded top-k, no full sort."""
    return df.orderBy(seeded_key(seed, key), key).limit(n)


def ordered_subset(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """A seeded subset of n rows, in their own order."""
    return seeded_head(df, n, seed, key).orderBy(key)


def evenly_spaced(df: DataFrame, order: str, k: int) -> DataFrame:
    """k rows at even steps from the first to the last by `order`, positions truncated; all rows where k is beyond them."""
    n = df.count()
    at = sorted({int(i * (n - 1) / (k - 1)) if k > 1 else 0 for i in range(k)}) if n and k else []
    return placed(df, [], [order], "_at").where(F.col("_at").isin(at)).drop("_at")


def drawn_copies(df: DataFrame, by: str, key: str, seed: int) -> DataFrame:
    """df with `copies`: how often each row is drawn in as many draws as there are rows, with replacement, every class alike.

    Draw number i takes a class and then a row of it by the digits of an MD5 of (seed, i), so the
    copies sum to the rows, classes are equal in expectation, and a rerun on any layout draws the
    same. Draws are counted by (class, place) before rows join them; a large class is many keys. key is
    unique within a class. A null class is a class.
    """
    spark = df.sparkSession
    rows = placed(df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(by).alias("_by"), F.col(key).alias("_key")), ["_by"], ["_key"], "_place")
    # A row a class.
    classes = rows.groupBy("_by").agg(F.count("*").alias("_n"))
    classes = classes.withColumn("_class", F.row_number().over(Window.orderBy(F.col("_by").asc_nulls_first())).cast("long") - 1)
    total, many = df.count(), classes.count()
    if not total:
        return df.withColumn("copies", F.lit(0).cast("long"))
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    number = lambda at: F.conv(F.substring(digits, at, 15), 16, 10).cast("long")
    draws = spark.range(total).select((number(1) % many).alias("_class"), number(16).alias("_draw"))
    draws = draws.join(classes, "_class").groupBy("_by", (F.col("_draw") % F.col("_n")).alias("_place")).agg(F.count("*").alias("_copies"))
    same = (F.col("_place") == F.col("_at")) & F.col("_by").eqNullSafe(F.col("_of"))
    out = rows.join(draws.select(F.col("_by").alias("_of"), F.col("_place").alias("_at"), "_copies"), same, "left")
    return out.select(*(F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != "copies"), F.coalesce("_copies", F.lit(0)).cast("long").alias("copies"))


def balanced_replicates(df: DataFrame, by: str, key: str, seed: int) -> DataFrame:
    """df with `copies`: replicates that bring every class near the mean class size; a fraction is rounded by a seeded draw."""
    counts = df.groupBy(by).agg(F.count("*").alias("_n"))
    # A row a class.
    every = Window.partitionBy()
    rates = counts.select(by, (F.sum("_n").over(every).cast("double") / F.count("*").over(every) / F.col("_n")).alias("_rate"))
    draw = seeded_key(seed, key) / float(1 << 32)
    return df.join(rates, by).withColumn("copies", (F.floor("_rate") + (draw < F.col("_rate") - F.floor("_rate")).cast("int")).cast("long")).drop("_rate")


def reference_picks(df: DataFrame, n: int, seed: int, by: str, name: str) -> DataFrame:
    """n rows a class: observations first, topped up with web files, each in seeded order."""
    order = [F.col(name).startswith("web_").cast("int"), seeded_key(seed, by, name), F.col(name)]
    nth = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def replaced_rows(df: DataFrame, by: str, key: str, ok: str, seed: int) -> DataFrame:
    """(by, key, used): each row, with a usable row of its class in place of one that is not; null where a class has none.

    A bad row takes the usable row at its seeded place among its class's, by number."""
    good = placed(df.where(ok).select(by, F.col(key).alias("used")), [by], ["used"], "_at")
    sizes = good.groupBy(by).agg(F.count("*").alias("_n"))
    bad = df.where(f"NOT ({ok})").join(sizes, by, "left").withColumn("_at", F.when(F.col("_n") > 0, seeded_key(seed, key) % F.col("_n")))
    bad = bad.join(good, [by, "_at"], "left").select(by, key, "used")
    return df.where(ok).select(by, key, F.col(key).alias("used")).unionByName(bad)


def bucket_of(df: DataFrame, keyword: str, buckets: DataFrame) -> DataFrame:
    """df with the first bucket (by place) whose keywords hold its keyword, else null. buckets(place, bucket, keywords)."""
    words = buckets.select("place", "bucket", F.explode("keywords").alias(keyword)).groupBy(keyword).agg(F.min(F.struct("place", "bucket"))["bucket"].alias("bucket"))
    return df.join(words, keyword, "left")


def bucket_holdings(log: DataFrame, buckets: DataFrame, other: str = "other") -> DataFrame:
    """(bucket, n): how much of class `other` each bucket holds; observations count for other_fish, the rest by source_id; unmatched rows do not count."""
    key = F.when(F.col("source") == "inaturalist", "other_fish").otherwise(F.col("source_id"))
    counts = log.where(F.col("species") == other).groupBy(key.alias("bucket")).agg(F.count("*").alias("n"))
    return buckets.select("bucket").distinct().join(counts, "bucket", "left").na.fill(0, ["n"])


def order_mismatches(named: dict[str, DataFrame]) -> DataFrame:
    """(idx, names): positions at which lists of labels(idx, name) are not all equal, missing ones null; empty where all agree."""
    rows = None
    for source, df in named.items():
        own = df.select("idx", F.lit(source).alias("source"), "name")
        rows = own if rows is None else rows.unionByName(own)
    out = rows.groupBy("idx").agg(F.count("*").alias("n"), F.count_distinct("name").alias("k"), F.count("name").alias("m"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "name")))).alias("names"))
    return out.where((F.col("n") != len(named)) | (F.col("k") != 1) | (F.col("m") != len(named))).select("idx", "names")
