"""Queries that run a stream over a table to its end."""

from __future__ import annotations

import uuid

from gleanworks.plans.catalog import query
from gleanworks.session import STATE_STORE, checkpoint_root, table
from gleanworks.streaming import logs


@query("append_log_stream", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def append_log_stream(spark, sf_dir):
    """All events as a stream into a new log: the first of each (user_id, event_type)."""
    keys, columns = ["user_id", "event_type"], ["user_id", "event_type", "event_id"]
    folder = f"{checkpoint_root(spark)}/log-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    # The state store is a setting of the session, so the stream has a session of its own.
    apart = spark.newSession()
    apart.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    stream = apart.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").select(*columns)
    logs.append_stream(stream, f"{folder}/log", f"{folder}/state", keys, ["event_id"]).awaitTermination()
    return logs.read_log(spark, f"{folder}/log", stream.schema)
