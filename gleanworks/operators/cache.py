"""Predictions kept by what they were made from, so that a sweep over them needs no inference.

A prediction's key is a SHA-256 of the model's name, the preprocessing and the input itself. An input
that changed has another key and is scored; one that did not, wherever it lies, is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORED = "key string, p array<double>"


def fingerprint(content: Column, model: str, preprocess: str) -> Column:
    """The key of an input (binary or string); a null one has none. The parts' lengths keep their ends apart."""
    head = f"{len(model)}:{model}{len(preprocess)}:{preprocess}"
    return F.sha2(F.concat(F.lit(head).cast("binary"), content.cast("binary")), 256)


def stored(df: DataFrame, path: str) -> DataFrame:
    """(key, p) of the store at path; nothing where there is none yet. A key that two runs wrote counts once."""
    spark = df.sparkSession
    try:
        found = spark.read.schema(STORED).parquet(f"{path}/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)
    return found.groupBy("key").agg(F.first("p").alias("p"))


def cached_scores(df: DataFrame, content: str, model: str, preprocess: str, score: Callable[[DataFrame], DataFrame], path: str) -> tuple[DataFrame, int]:
    """(df with `p`, how many inputs were scored). score gives the rows of a table with content a column p array<double>.

    Only inputs whose key the store lacks are scored, equal ones once; their predictions are written to
    a new folder of the store, so a run that fails leaves the store as it was. A null input has no prediction."""
    keyed = df.withColumn("_key", fingerprint(F.col(content), model, preprocess))
    have = stored(df, path)
    wanted = keyed.where("_key IS NOT NULL").groupBy(F.col("_key").alias("key")).agg(F.first(content).alias(content))
    missing = wanted.join(have.select("key"), "key", "left_anti")
    part = f"{path}/{uuid.uuid4().hex}"
    score(missing).select("key", F.col("p").cast("array<double>").alias("p")).write.parquet(part)
    scored = df.sparkSession.read.schema(STORED).parquet(part).count()
    return keyed.join(stored(df, path).withColumnRenamed("key", "_key"), "_key", "left").drop("_key"), scored
