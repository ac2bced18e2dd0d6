"""The place of each row in an order, over a whole table or within groups, without one task for all."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.session import durable

#: Rows that one task ranks, at about; a table has as many pieces as it asks for.
PIECE = 200_000


def placed(df: DataFrame, by: list[str], order: list[str | Column], name: str = "place") -> DataFrame:
    """df with the 0-based place of each row among those of its `by` (nulls alike) in `order`.

    Rows are dealt to pieces by ranges of (by, order), so equal scores part by what comes after them
    in the order and a large group is many pieces; a row's place is its place in its piece and the
    rows of the pieces before. Rows equal in all of `order` are in any order.
    """
    n = df.count()
    if n <= PIECE:
        alone = Window.partitionBy(*by or [F.lit(0)]).orderBy(*order)
        return df.withColumn(name, F.row_number().over(alone).cast("long") - 1)
    # The ranges come from a sample, so rows are written with their pieces, once.
    cut = durable(df.repartitionByRange(math.ceil(n / PIECE), *by, *order).withColumn("_piece", F.spark_partition_id()))
    before = Window.partitionBy(*by or [F.lit(0)]).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*by, "_piece").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.select(*(F.col(b).alias(f"_by{i}") for i, b in enumerate(by)), F.col("_piece").alias("_of"), "_before")
    own = cut.withColumn("_own", F.row_number().over(Window.partitionBy("_piece", *by).orderBy(*order)).cast("long") - 1)
    same = F.col("_piece") == F.col("_of")
    for i, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_by{i}"))
    return own.join(counts, same).withColumn(name, F.col("_own") + F.col("_before")).select(*df.columns, name)
