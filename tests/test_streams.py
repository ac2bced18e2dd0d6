"""The append log as a stream, over several cuttings of one input."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gleanworks.operators import curation as cu
from gleanworks.streaming import logs

SCHEMA = "k string, n int, collected_at string"


def rows():
    rnd = random.Random(2)
    return [(rnd.choice([None, "a", "b", "c", "d", "e"]), i, rnd.choice([None, "", "2020-01-01"])) for i in range(40)]


def run(spark, tmp_path, name, cuts, **more):
    """Each cut is put into the folder and the stream run to its end: a restart a cut."""
    for part in cuts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / f"{name}-in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / f"{name}-in"))
        logs.append_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}-at"), ["k"], ["n"], **more).awaitTermination(120)
    return sorted(((r["k"], r["n"], r["collected_at"]) for r in logs.read_log(spark, str(tmp_path / name), SCHEMA).collect()), key=str)


def test_any_cutting_gives_the_batch_forms_rows(spark, tmp_path):
    data, today = rows(), datetime.datetime.now(datetime.timezone.utc).date().isoformat()
    df = spark.createDataFrame(data, SCHEMA)
    want = sorted(((r["k"], r["n"], r["collected_at"] or today) for r in cu.first_copies(df, ["k"], ["n"]).collect()), key=str)
    for name, cuts in (("one", [data]), ("three", [data[:3], data[3:20], data[20:]])):
        assert run(spark, tmp_path, name, cuts) == want


def test_a_log_from_before_is_known(spark, tmp_path):
    known = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    got = run(spark, tmp_path, "log", [rows()], known=known)
    assert {k for k, _, _ in got} == {k for k, _, _ in rows()} - {"a", None}


def test_a_batch_run_again_replaces_its_own_rows(spark, tmp_path):
    first, second = (spark.createDataFrame([(k, i, "x")], SCHEMA) for i, k in enumerate("ab"))
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        logs.write_batch(batch, str(tmp_path / "log"), number)
    assert sorted(tuple(r)[:2] for r in logs.read_log(spark, str(tmp_path / "log"), SCHEMA).collect()) == [("a", 0), ("b", 1)]


def test_state_store_is_asked_for(spark):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.unset(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            logs.new_rows(spark.readStream.format("rate").load().withColumn("k", F.col("value")), ["k"], ["value"])
    finally:
        spark.conf.set(provider, before)
