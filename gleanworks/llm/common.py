"""Helpers of the training-data operators: durable intermediate tables, ranks, literal tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Used only when a local session names no checkpoint folder, as in tests on one machine.
OWN_CHECKPOINTS = "file:///tmp/gleanworks-checkpoints"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; a cluster must name one."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return OWN_CHECKPOINTS


def durable(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder that the cluster shares, with its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As durable, as a Parquet table in that folder: a fraction of a checkpoint's bytes for long tables of small numbers."""
    path = f"{checkpoint_root(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small driver-side plan as a DataFrame, by JSON parsing in the JVM."""
    arrays = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(arrays))


#: A key counts as hot beyond this share of the rows, so at most HOT_KEYS keys do, and beyond HOT_ROWS rows.
HOT_KEYS, HOT_ROWS = 1000, 20_000


def hot_limit(n_rows: int) -> int:
    return max(HOT_ROWS, n_rows // HOT_KEYS)


def ranked(df: DataFrame, keys: list[str], order: list[str], hot: list[dict], n_rows: int, rank: str = "rank") -> DataFrame:
    """Adds the 0-based rank of each row within its keys, whatever a key's share of the rows.

    hot: {key: value, ..., "n": rows} of the keys with more than hot_limit(n_rows) rows, HOT_KEYS at
    most. Only their rows are dealt to pieces by a hash of the order columns, as many as their own
    count asks for; pieces are ranked alone and shifted by the counts of the pieces before them, so
    no task gets a whole hot key. The order is by the order columns, in a hot key by piece first: the
    same on each run. Keys must not be null.
    """
    limit = hot_limit(n_rows)
    if not hot:
        return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)
    kinds = dict(df.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", _pieces int"
    # At most HOT_KEYS rows here and 2 x HOT_KEYS in shifts.
    parts = literal_table(df.sparkSession, [{k: r[k] for k in keys} | {"_pieces": -(-r["n"] // limit)} for r in hot], schema)
    df = df.join(F.broadcast(parts), keys, "left").withColumn("_piece", F.pmod(F.xxhash64(*order), F.coalesce("_pieces", F.lit(1))).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = df.where("_pieces IS NOT NULL").groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    shifts = shifts.select(*keys, "_piece", F.sum("_n").over(before).alias("_shift"))
    own = Window.partitionBy(*keys, "_piece").orderBy(*order)
    out = df.withColumn("_own", F.row_number().over(own) - 1).join(F.broadcast(shifts), [*keys, "_piece"], "left")
    return out.withColumn(rank, F.col("_own").cast("long") + F.coalesce("_shift", F.lit(0))).drop("_own", "_shift", "_piece", "_pieces")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def groups(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive rows of `most` bytes or one row."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def text_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """(rows, their texts as UTF-8) of batches with a column `text`, in groups of `most` bytes or one row; null texts are empty.

    Texts are taken from Arrow's memory a group at a time, never a whole batch as Python objects."""
    for batch in batches:
        texts = batch.column("text")
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for part in groups(sizes, most):
            own = texts.slice(part.start, part.stop - part.start)
            yield batch.slice(part.start, part.stop - part.start), [t or b"" for t in own.cast(pa.large_binary()).to_pylist()]


def joined_bytes(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of a binary column as one array of numbers, straight from Arrow's buffers."""
    parts = []
    for chunk in column.chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)
            data, first, last = chunk.buffers()[2], ends[chunk.offset], ends[chunk.offset + len(chunk)]
            if last > first:
                parts.append(np.frombuffer(data, np.uint8)[first:last])
    whole = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return whole.view(dtype)
