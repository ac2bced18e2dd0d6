"""A corpus pipeline: toxicity, near copies, source mix, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of docs, whatever their names.

Nulls: a null text is clean, near to nothing, without words and packed as an empty one; a null id or
source goes through all stages. Very long texts go through whole. Repeated rows and ties: of equal
texts one row stays, that of the least id (null last); rows without words all stay. An empty table
gives an empty result. Extra columns are kept up to packing, which returns its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gleanworks.llm.common import checkpoint_root
from gleanworks.llm.mixing import mixed_documents
from gleanworks.llm.ngram_join import one_of_each
from gleanworks.llm.packing import packed_documents
from gleanworks.llm.toxicity import without_toxic
from gleanworks.session import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the compression-distance classifier predicts toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources come near their target shares."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' ids into sequences of at most 2048."""
    return packed_documents(docs)


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("mixing", mixing), ("packing", packing)]

#: No SQL: the first stage is a trained classifier. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
