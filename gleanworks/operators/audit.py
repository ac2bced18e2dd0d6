"""Quality audits, histories and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.operators.evaluation import reached
from gleanworks.operators.places import placed


def score_buckets(df: DataFrame, score: str, order: list[str], hits: dict[str, Column], buckets: int = 10) -> DataFrame:
    """Buckets of n // buckets rows by ascending score (1 at least); the last takes the rest. Null scores come last."""
    size = max(df.count() // buckets, 1)
    ranked = placed(df, [], [F.col(score).asc_nulls_last(), *order], "_place")
    bucket = F.least(F.floor(F.col("_place") / size), F.lit(buckets - 1)).cast("int")
    means = [F.avg(c.cast("double")).alias(name) for name, c in hits.items()]
    return ranked.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min(score).alias("low"), F.max(score).alias("high"), *means)


def summary_by(df: DataFrame, by: str, score: Column, hit: Column) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.avg(hit.cast("double")).alias("hit"), F.avg(score).alias("mean_score"))


def keep_drop(df: DataFrame, score: str, hit: Column, values: list[float]) -> DataFrame:
    """(t, drop_share, kept_hit, dropped_hit) where a row drops below t; NaN where none drops, no row where none stays."""
    sums = {"hits": F.sum(hit.cast("double")), "told": F.count(hit)}
    out = reached(df, score, values, sums)
    mean = lambda a, b: F.try_divide(a, b)
    apart = lambda c: F.col(f"{c}_all") - F.coalesce(c, F.lit(0))
    out = out.select(
        "t", mean((F.col("n_all") - F.col("n")).cast("double"), F.col("n_all")).alias("drop_share"), mean(F.col("hits"), F.col("told")).alias("kept_hit"),
        F.coalesce(mean(apart("hits"), apart("told")), F.lit(float("nan"))).alias("dropped_hit"),
    )
    return out.where(F.col("kept_hit").isNotNull())


def drops(df: DataFrame, by: str, score: str, values: list[float]) -> DataFrame:
    """(by, t, dropped, share): rows below each threshold."""
    dropped = F.col("n_all") - F.col("n")
    return reached(df, score, values, {}, [by]).select(by, "t", dropped.alias("dropped"), F.try_divide(dropped.cast("double"), F.col("n_all")).alias("share"))


def early_stop(history: DataFrame, epoch: str, score: str, patience: int) -> DataFrame:
    """history with best_before, improved, bad (epochs since the last improvement) and stopped; a row an epoch."""
    before = Window.orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    best = F.coalesce(F.max(score).over(before), F.lit(0.0))
    df = history.withColumn("best_before", best).withColumn("improved", F.col(score) > F.col("best_before"))
    last = F.max(F.when(F.col("improved"), F.col("_row"))).over(Window.orderBy(epoch))
    df = df.withColumn("_row", F.row_number().over(Window.orderBy(epoch)))
    df = df.withColumn("bad", (F.col("_row") - F.coalesce(last, F.lit(0))).cast("long")).drop("_row")
    return df.withColumn("stopped", F.max((F.col("bad") >= patience).cast("int")).over(before) == 1).na.fill(False, ["stopped"])
