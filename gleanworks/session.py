"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


#: What streams with keyed state of their own need; a cluster sets it for spark.sql.streaming.stateStore.providerClass.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with AQE; cluster settings come from spark-submit instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gleanworks")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def smoke_dir() -> str:
    return os.environ.get("SMOKE_SF_DIR", "/root/testdata/sf0.001")


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
