"""Streaming forms of the append log and of serving. The batch operators are the originals; these are extras."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from gleanworks.operators.evaluation import served_rows, with_ranks

#: A log's own column of the day on which a row came, filled where a row has none.
COLLECTED = "collected_at"


def first_wins(stream: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are remembered for `delay` of event time, so state is bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


class FirstOfKey(StatefulProcessor):
    """Emits the least row of a key, by `order`, of the first batch that has it; then the key is known until it expires."""

    def __init__(self, order: list[str], columns: list[str], expiry_ms: int | None) -> None:
        self.order, self.columns, self.expiry_ms = order, columns, expiry_ms

    def init(self, handle) -> None:
        self.known = handle.getValueState("known", T.StructType([T.StructField("known", T.BooleanType())]), self.expiry_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        place = lambda r: tuple((r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in self.order)
        first = min(rows, key=place)
        if not self.known.exists():
            self.known.update((True,))
            yield Row(**{c: first[c] for c in self.columns})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.known.update((True,))


def new_rows(stream: DataFrame, keys: list[str], order: list[str], known: DataFrame | None = None, expiry_ms: int | None = None) -> DataFrame:
    """The rows of a stream to append to a log: the first of each key, none of the keys in `known` (those of a log from before).

    State is a flag a key, which goes `expiry_ms` after it was set; without an expiry keys are known for ever. Null keys are keys."""
    conf = stream.sparkSession.conf
    if "RocksDB" not in conf.get("spark.sql.streaming.stateStore.providerClass"):
        raise ValueError("keyed state needs spark.sql.streaming.stateStore.providerClass to be the RocksDB provider")
    start = None if known is None else known.select(*keys).distinct().withColumn("_known", F.lit(True)).groupBy(*keys)
    mode = "None" if expiry_ms is None else "ProcessingTime"
    return stream.groupBy(*keys).transformWithState(FirstOfKey(order, stream.columns, expiry_ms), stream.schema, "Append", mode, start)


def log_path(path: str, number: int) -> str:
    return f"{path}/batch={number}"


def write_batch(batch: DataFrame, path: str, number: int) -> None:
    """Writes a batch's rows under its number; a batch that is run again replaces its own and no other's."""
    batch.write.mode("overwrite").parquet(log_path(path, number))


def read_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A log's rows over all batches."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*kinds.fields, T.StructField("batch", T.LongType())])).parquet(path).drop("batch")


def append_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], known: DataFrame | None = None, expiry_ms: int | None = None):
    """Starts appending the new rows of a stream to the log at path; each batch touches its own keys only, never the log.

    Where there is a column collected_at, rows without one get the batch's day, which Spark records with the batch, so that a rerun gives the same."""
    rows = new_rows(stream, keys, order, known, expiry_ms)
    if COLLECTED in rows.columns:
        rows = rows.withColumn(COLLECTED, F.coalesce(F.nullif(F.col(COLLECTED), F.lit("")), F.date_format(F.current_timestamp(), "yyyy-MM-dd")))
    writer = rows.writeStream.foreachBatch(lambda batch, number: write_batch(batch, path, number))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def serve(stream: DataFrame, t: float, other: int, k: int = 3) -> DataFrame:
    """Ranked candidates for a stream of (id, p)."""
    return served_rows(with_ranks(stream), t, other, k)
