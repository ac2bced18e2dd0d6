"""Batch scoring and training on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_scores(df: DataFrame, vec_col: str, weights: list[list[float]], out: str = "scores", batch: int = 4096) -> DataFrame:
    """df with the scores of a linear model: one matrix product a batch of rows."""

    def load():
        w = np.array(weights, np.float64)
        return lambda x: x.astype(np.float64) @ w

    score = predict_batch_udf(load, return_type=T.ArrayType(T.DoubleType()), batch_size=batch, input_tensor_shapes=[[len(weights)]])
    return df.withColumn(out, score(F.col(vec_col)))


def acceptance(score: Column, least: float, exempt: Column | None = None) -> Column:
    """struct<ok, reason>: the pluggable acceptance rule; a null score is 0. Rows that are exempt (`other`) pass whatever their score."""
    s = F.coalesce(score, F.lit(0.0))
    ok = s >= least if exempt is None else (s >= least) | F.coalesce(exempt, F.lit(False))
    return F.struct(ok.alias("ok"), F.when(ok, "ok").otherwise(F.concat(F.lit("low_fish_"), F.format_number(s, 3))).alias("reason"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """df with weight = n / (classes * n of the class); counts are joined, so no class sits in one task."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = Window.partitionBy()
    counts = counts.withColumn("weight", F.sum("_n").over(total) / (F.count("*").over(total) * F.col("_n"))).drop("_n")
    return df.join(counts, label)


def train(df: DataFrame, vec_col: str, label: str, iterations: int = 30):
    """A class-weighted logistic regression on vectors; returns the fitted pipeline."""
    rows = balanced_weights(df.select(array_to_vector(vec_col).alias("features"), F.col(label).cast("double").alias("label")), "label")
    return Pipeline(stages=[LogisticRegression(weightCol="weight", maxIter=iterations, regParam=0.01)]).fit(rows)


def apply_model(model, df: DataFrame, vec_col: str) -> DataFrame:
    """df with p (array<double>) and pred."""
    out = model.transform(df.withColumn("features", array_to_vector(vec_col)))
    return out.withColumn("p", vector_to_array("probability")).withColumn("pred", F.col("prediction").cast("int")).drop("features", "rawPrediction", "probability", "prediction")


def save_model(model, classes: list[str], path: str) -> None:
    """The fitted pipeline and the order of its classes."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    rows = list(enumerate(classes))
    SparkSession.active().createDataFrame(rows, "idx int, name string").write.mode("overwrite").parquet(f"{path}/classes")


def load_model(spark, classes: list[str], path: str):
    """A saved pipeline; refused unless its classes are these, in this order."""
    from pyspark.ml import PipelineModel

    saved = [r["name"] for r in spark.read.parquet(f"{path}/classes").orderBy("idx").collect()]
    if saved != list(classes):
        raise ValueError(f"the model's classes are {saved}")
    return PipelineModel.load(f"{path}/model")


def contract_errors(shape_in: list, shape_out: list, classes: int, size: int, other_name: str, named: str) -> list[str]:
    """What a model's declared shapes break: rank 4, 3 channels, the fixed size, a score a class, and the name of `other`."""
    rules = (
        (len(shape_in) == 4, "rank"), (len(shape_in) > 1 and shape_in[1] == 3, "channels"),
        (len(shape_in) == 4 and list(shape_in[2:]) == [size, size], "size"), (bool(shape_out) and shape_out[-1] == classes, "classes"), (other_name == named, "other"),
    )
    return [name for ok, name in rules if not ok]
