"""Label and metrics documents as VARIANT values: built from tables, kept in Parquet, read back by path."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the model block of a label document always says.
MODEL_FIXED = {"input_name": "input", "output_name": "logits", "opset": 18, "applies_softmax": False}


def label_document(classes: DataFrame, other: str, threshold: float, top_k: int) -> DataFrame:
    """(document variant): the label dictionary of classes(idx, name, scientific, habitat, difficulty), names in order of idx.

    As long as there are classes; `other` that is no class gives a null other_index. No classes give an empty dictionary."""
    rows = F.sort_array(F.collect_list(F.struct("idx", "name", "scientific", "habitat", "difficulty")))
    one = classes.agg(rows.alias("rows"))
    names = F.transform("rows", lambda r: r["name"])
    species = F.map_from_entries(F.transform("rows", lambda r: F.struct(r["name"], F.struct(r["scientific"].alias("scientific"), r["habitat"].alias("habitat"), r["difficulty"].alias("difficulty")))))
    place = F.nullif(F.array_position(names, other), F.lit(0).cast("long")) - 1
    body = F.struct(
        F.size("rows").alias("num_classes"), names.alias("classes"), F.lit(other).alias("other_class"), place.alias("other_index"),
        F.lit(threshold).alias("confidence_threshold"), F.lit(top_k).alias("top_k"), species.alias("species"),
    )
    return one.select(as_variant(F.to_json(body)).alias("document"))


def as_variant(text: Column) -> Column:
    return F.parse_json(text)


def with_blocks(documents: DataFrame, blocks: dict[str, dict]) -> DataFrame:
    """documents with top-level blocks put in, in place of those of the same name."""
    have = F.from_json(F.to_json("document"), "map<string,variant>")
    kept = F.map_filter(have, lambda k, _: ~k.isin(*blocks))
    new = F.from_json(F.lit(json.dumps(blocks)), "map<string,variant>")
    return documents.withColumn("document", as_variant(F.to_json(F.map_concat(kept, new))))


def stamped(documents: DataFrame, img_size: int, mean: list[float], std: list[float], backbone: str, version: str) -> DataFrame:
    """documents with the preprocess and model blocks that serving reads."""
    pre = {"img_size": img_size, "resize_shorter_to": int(img_size * 1.14), "mean": mean, "std": std, "interpolation": "bilinear"}
    return with_blocks(documents, {"preprocess": pre, "model": {"backbone": backbone, "version": version, **MODEL_FIXED}})


def with_threshold(documents: DataFrame, threshold: float) -> DataFrame:
    """documents with another confidence threshold."""
    have = F.from_json(F.to_json("document"), "map<string,variant>")
    kept = F.map_filter(have, lambda k, _: k != "confidence_threshold")
    return documents.withColumn("document", as_variant(F.to_json(F.map_concat(kept, F.from_json(F.lit(json.dumps({"confidence_threshold": threshold})), "map<string,variant>")))))


def at(path: str, kind: str, document: str = "document") -> Column:
    """A value of a document by its path, null where it isn't there."""
    return F.try_variant_get(F.col(document), path, kind)


def species_rows(documents: DataFrame) -> DataFrame:
    """(idx, name, scientific, habitat, difficulty) of a label document."""
    found = documents.select(F.posexplode(at("$.classes", "array<string>")).alias("idx", "name"), at("$.species", "map<string,struct<scientific:string,habitat:string,difficulty:string>>").alias("species"))
    own = F.try_element_at("species", F.col("name"))
    return found.select("idx", "name", own["scientific"].alias("scientific"), own["habitat"].alias("habitat"), own["difficulty"].alias("difficulty"))


def missing_blocks(documents: DataFrame) -> DataFrame:
    """(missing array): the keys of the preprocess block that a document lacks; serving refuses to guess them."""
    keys = ("img_size", "resize_shorter_to", "mean", "std")
    return documents.select(F.array_compact(F.array(*(F.when(at(f"$.preprocess.{k}", "variant").isNull(), k) for k in keys))).alias("missing"))


def health(documents: DataFrame, tta: bool = False) -> DataFrame:
    """(code, body): the health answer; without a document the model isn't loaded and the code is 503."""
    body = F.to_json(F.struct(
        F.lit("ok").alias("status"), at("$.model.version", "string").alias("model_version"), at("$.num_classes", "int").alias("num_classes"),
        at("$.preprocess.img_size", "int").alias("img_size"), F.lit(tta).alias("tta"), at("$.confidence_threshold", "double").alias("confidence_threshold"),
    ))
    return _answer(documents, body, '{"status":"unavailable","error":"MODEL_NOT_LOADED"}')


def labels(documents: DataFrame) -> DataFrame:
    """(code, body): the label answer, its classes in order."""
    body = F.to_json(F.struct(at("$.classes", "array<string>").alias("classes"), at("$.other_class", "string").alias("other_class"), at("$.species", "variant").alias("species")))
    return _answer(documents, body, '{"error":"MODEL_NOT_LOADED"}')


def _answer(documents: DataFrame, body: Column, none: str) -> DataFrame:
    one = documents.select(body.alias("body")).agg(F.first("body").alias("body"))
    return one.select(F.when(F.col("body").isNull(), 503).otherwise(200).alias("code"), F.coalesce("body", F.lit(none)).alias("body"))


def save_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").parquet(path)


def load_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
