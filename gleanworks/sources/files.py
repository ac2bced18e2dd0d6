"""Readers and writers of the side tables: explicit schemas, one function a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

from gleanworks.functions.scalars import SUFFIXES, suffix_of

LICENCE_LOG = "filename string, species string, source string, source_id string, license string, author string, url string, collected_at string"
SCORES = "split string, species string, filename string, fish_prob double"
DUP_GROUPS = "species string, group int, filename string"
MANIFEST = "species string, filename string"
PREDICTIONS = "path string, filename string, source string, true string, pred string, confidence double, correct_top1 int, correct_top3 int"
PREFILTER = "species string, filename string, verdict string, fish_prob double, food_prob double, text_prob double, top1 string, top1_prob double"
HISTORY = "epoch int, stage int, lr double, train_loss double, train_top1 double, val_loss double, val_top1 double, val_top3 double"


def _found(load, empty):
    """load(), or empty() where the path does not exist."""
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty()


def read_csv(spark: SparkSession, path: str, schema: str, with_line: bool = False) -> DataFrame:
    """A UTF-8 table with a header; columns go by position, so a byte order mark in the header is harmless.

    A missing file is an empty table. with_line adds `line`, which orders the rows as they stand in the files."""
    df = _found(lambda: spark.read.csv(path, schema=schema, header=True, enforceSchema=True), lambda: None)
    if df is None:
        df = spark.createDataFrame([], schema)
        return df.withColumn("line", F.lit(None).cast("struct<file:string,block:bigint,row:bigint>")) if with_line else df
    line = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", line.alias("line")) if with_line else df


def image_files(spark: SparkSession, root: str, with_content: bool = False) -> DataFrame:
    """(class, filename, path, length[, content]) of the images in root/<class>/, by suffix in any case.

    A missing folder is empty; files in deeper folders are not listed."""
    load = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = _found(load, lambda: spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary"))
    parts = F.split("path", "/")
    files = files.where(F.element_at(parts, -3) == root.rstrip("/").rsplit("/", 1)[-1])
    df = files.withColumn("class", F.element_at(parts, -2)).withColumn("filename", F.element_at(parts, -1))
    df = df.where(suffix_of(F.col("filename")).isin(*SUFFIXES))
    return df.select("class", "filename", "path", "length", *(["content"] if with_content else []))


def labelled_files(files: DataFrame, classes: DataFrame, scores: DataFrame | None = None, least: float | None = None) -> DataFrame:
    """files with the index of their class; with a threshold, those that score it or have no score."""
    df = files.join(F.broadcast(classes), "class")
    if least is None:
        return df
    if scores is None or scores.isEmpty():
        raise ValueError("a threshold needs a score table")
    last = latest_scores(scores, "line" if "line" in scores.columns else None)
    df = df.join(last, ["class", "filename"], "left").withColumn("fish_prob", F.coalesce("fish_prob", F.lit(1.0)))
    return df.where(F.col("fish_prob") >= least)


def latest_scores(scores: DataFrame, order: str | None = "line") -> DataFrame:
    """(class, filename, fish_prob): of several rows of a key, the last by `order`, a column that read_csv adds; without one the greatest score."""
    last = F.max_by("fish_prob", order) if order else F.max("fish_prob")
    return scores.groupBy(F.col("species").alias("class"), "filename").agg(last.alias("fish_prob"))


def rejected_list(spark: SparkSession, path: str) -> DataFrame:
    """(class, filename) from lines `class/filename`: blank lines, # lines and lines without / are skipped; the first / splits."""
    line = spark.read.text(path).select(F.trim("value").alias("line"))
    line = line.where((F.col("line") != "") & ~F.col("line").startswith("#") & F.contains("line", F.lit("/")))
    at = F.instr("line", "/")
    return line.select(F.substring("line", F.lit(1), at - 1).alias("class"), F.substring("line", at + 1, F.length("line")).alias("filename")).distinct()


def manifest_keys(manifest: DataFrame) -> DataFrame:
    return manifest.select("species", "filename").where("species <> '' AND filename <> ''").distinct()


def licence_keys(log: DataFrame) -> DataFrame:
    """The keys of a licence log: only an empty file name drops a row."""
    return log.select("species", "filename").where("filename <> ''").distinct()


def picked_files(spark: SparkSession, paths: list[str], suffixes: tuple[str, ...] = (*SUFFIXES, ".heic")) -> DataFrame:
    """(path, filename, length) of the files and of the folders' own children among paths, by suffix in any case."""
    df = spark.read.format("binaryFile").load(paths)
    filename = F.element_at(F.split("path", "/"), -1)
    return df.select("path", filename.alias("filename"), "length").where(suffix_of(filename).isin(*suffixes))


def manifest_versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions of a manifest; a row a commit."""
    log = _found(lambda: spark.read.schema("version long").parquet(f"{path}/commits"), lambda: spark.createDataFrame([], "version long"))
    return sorted(r["version"] for r in log.distinct().collect())


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(species, filename) of the last committed version or of the one asked for; nothing before the first."""
    have = manifest_versions(spark, path)
    if not have:
        return spark.createDataFrame([], MANIFEST)
    at = f"{path}/version={have[-1] if version is None else version}"
    return _found(lambda: spark.read.schema(MANIFEST).parquet(at), lambda: spark.createDataFrame([], MANIFEST))


def write_manifest(df: DataFrame, path: str, species: list[str] | None = None) -> int:
    """Commits a new version: the named classes have just the rows of df (none, where df has none), the others stay as they are.

    Without names, the classes are those of df. The version is written whole beside the last one and counts
    from its commit on, so readers see either, and a commit that fails leaves the last. Returns its number."""
    spark = df.sparkSession
    rows = manifest_keys(df)
    named = rows.select("species").distinct() if species is None else spark.createDataFrame([(s,) for s in species], "species string")
    kept = read_manifest(spark, path).join(named, "species", "left_anti")
    number = max(manifest_versions(spark, path), default=0) + 1
    whole = kept.unionByName(rows.join(named, "species", "left_semi"))
    whole.repartition("species").sortWithinPartitions("species", "filename").write.mode("overwrite").partitionBy("species").parquet(f"{path}/version={number}")
    spark.range(1).select(F.lit(number).cast("long").alias("version")).write.mode("append").parquet(f"{path}/commits")
    return number


def append_history(history: DataFrame, path: str) -> DataFrame:
    """Appends epochs to a history table, by its schema; returns the whole table in order of epoch."""
    kinds = dict(f.split() for f in HISTORY.split(", "))
    history.select(*(F.col(c).cast(k) for c, k in kinds.items())).coalesce(1).write.mode("append").parquet(path)
    return history.sparkSession.read.schema(HISTORY).parquet(path).orderBy("epoch")


def archive(files: DataFrame, path: str) -> None:
    """Files with their content and CRC-32, by split."""
    files.withColumn("crc", F.crc32("content")).write.partitionBy("split").mode("overwrite").parquet(path)


def verify_archive(spark: SparkSession, path: str) -> DataFrame:
    """(split, files, damaged) of an archive."""
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("files"), F.count_if(F.crc32("content") != F.col("crc")).alias("damaged"))
