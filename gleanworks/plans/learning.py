"""Model queries on embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanworks.functions.arrays import rounded
from gleanworks.operators import learning as le
from gleanworks.operators import training as tr
from gleanworks.plans.catalog import query
from gleanworks.session import table

#: A fixed linear scorer: class c weighs dimension d by ((7 d + 3 c) mod 11 - 5) / 8, exact in binary.
WEIGHTS = [[((7 * d + 3 * c) % 11 - 5) / 8 for c in range(4)] for d in range(64)]
_DOT = ", ".join(f"round(list_sum(list_transform(range(64), lambda d: CAST(embedding[d + 1] AS DOUBLE) * ((7 * d + {3 * c}) % 11 - 5) / 8)), 6) AS s{c}" for c in range(4))


@query("batch_predict", f"SELECT vec_id, {_DOT} FROM embeddings")
def batch_predict(spark, sf_dir):
    df = le.batch_scores(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", WEIGHTS)
    return df.select("vec_id", *(rounded(F.element_at("scores", c + 1), 6).alias(f"s{c}") for c in range(4)))


@query("train_classifier")
def train_classifier(spark, sf_dir):
    """Trained on four fifths of the vectors; the predictions of the rest."""
    df = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    fold = F.pmod(F.xxhash64("vec_id"), F.lit(5))
    model = le.train(df.where(fold != 0), "embedding", "label")
    return le.apply_model(model, df.where(fold == 0).select("vec_id", "embedding", F.col("label").alias("y")), "embedding").select("vec_id", "y", "pred")


@query("acceptance_reasons", """WITH s AS (SELECT doc_id, source, CASE WHEN doc_id % 13 = 0 THEN 0.0 ELSE (doc_id * 37 % 101) / 100 END AS score FROM documents)
SELECT doc_id, coalesce(score >= 0.4 OR source = 'src0', false) AS ok, CASE WHEN coalesce(score >= 0.4 OR source = 'src0', false) THEN 'ok' ELSE printf('low_fish_%.3f', score) END AS reason FROM s""")
def acceptance_reasons(spark, sf_dir):
    """The acceptance rule, one source exempt as `other` is, a null score as 0."""
    score = F.when(F.col("doc_id") % 13 != 0, F.col("doc_id") * 37 % 101 / 100)
    return table(spark, sf_dir, "documents").select("doc_id", le.acceptance(score, 0.4, F.col("source") == "src0").alias("a")).select("doc_id", "a.ok", "a.reason")


@query("train_two_stages")
def train_two_stages(spark, sf_dir):
    """The history of both stages on four fifths of the vectors, the rest for validation."""
    df = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    fold = F.pmod(F.xxhash64("id"), F.lit(5))
    classes = df.agg(F.max("label").alias("n")).first()["n"] + 1
    _, history = tr.train_stages(df.where(fold != 0), df.where(fold == 0), "embedding", "label", classes, tr.Plan(epochs=6))
    return tr.history_table(spark, history)
