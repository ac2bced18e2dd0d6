"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots; each shard owns the slots up to its virtual nodes. A row's
key falls into a slot by hash. Shards have capacities that are at most one row apart and sum to
the row count; rows beyond a full shard's capacity continue clockwise to the next shard with room.
Only the row counts of the slots reach the driver (RING_SLOTS numbers at any data size); there
the walk is made over counts, and rows find their place by their rank in their slot.

Nulls: a null key hashes like any other value; a null text has no bytes and counts as size 1.
Repeated rows and keys: rows are ranked, so copies share a slot of the ring but may part where
a shard fills up. Empty input: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, hot_limit, literal_table, ranked, text_or_empty
from gleanworks.session import table

RING_SLOTS = 4096
VIRTUAL_NODES = 64


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, slots: int = RING_SLOTS) -> list[list[int]]:
    """For each slot, all shards in the order in which a clockwise walk first meets them."""
    place = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % slots
    nodes = sorted((place(s, v), s) for s in range(shards) for v in range(virtual_nodes))
    at, walks = [p for p, _ in nodes], []
    for slot in range(slots):
        start, met = bisect.bisect_left(at, slot), []
        for i in range(len(nodes)):
            if (s := nodes[(start + i) % len(nodes)][1]) not in met:
                met.append(s)
                if len(met) == shards:
                    break
        walks.append(met)
    return walks


def walk_plan(counts: dict[int, int], shards: int, **kwargs) -> list[dict]:
    """Runs (ring_slot, first, last, shard, base): ranks first..last-1 of a slot go to shard, from its place base on."""
    total, walks = sum(counts.values()), ring(shards, **kwargs)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, left, runs = [0] * shards, dict(counts), []
    for step in range(shards):
        for slot in sorted(left):
            shard = walks[slot][step]
            if n := min(left[slot], room[shard] - used[shard]):
                first = counts[slot] - left[slot]
                runs.append({"ring_slot": slot, "first": first, "last": first + n, "shard": shard, "base": used[shard]})
                used[shard] += n
                left[slot] -= n
        left = {k: v for k, v in left.items() if v}
    return runs


def shard_rows(df: DataFrame, key: str, order: list[str], shards: int) -> DataFrame:
    """df with ring_slot, shard and slot (the place in the shard, gapless from 0), in place of columns of those names."""
    # The caller's columns go along in a struct, so that none of their names can clash.
    own, by = F.struct(*(F.col(f"`{c}`") for c in df.columns)), [f"_by{i}" for i in range(len(order))]
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(RING_SLOTS)).cast("int")
    keyed = durable(df.select(own.alias("_row"), slot.alias("ring_slot"), *(F.col(c).alias(b) for c, b in zip(order, by))))
    counts = {r["ring_slot"]: r["count"] for r in keyed.groupBy("ring_slot").count().collect()}
    runs, n_rows = literal_table(df.sparkSession, walk_plan(counts, shards), "ring_slot int, first long, last long, shard int, base long"), sum(counts.values())
    rows = ranked(keyed, ["ring_slot"], by, [{"ring_slot": k, "n": n} for k, n in counts.items() if n > hot_limit(n_rows)], n_rows)
    # At most RING_SLOTS x shards runs, at any data size.
    placed = rows.join(F.broadcast(runs), "ring_slot").where("rank >= first AND rank < last")
    placed = placed.withColumn("slot", F.col("base") + F.col("rank") - F.col("first"))
    return placed.select(*(F.col(f"_row.`{c}`") for c in df.columns if c not in ("ring_slot", "shard", "slot")), "ring_slot", "shard", "slot")


def op8_ring_shards(spark, sf_dir):
    """All documents into shards 0 to 7, row counts at most one apart (law `rows`)."""
    text = text_or_empty()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    placed = shard_rows(docs, "doc_id", ["doc_id", "text_crc32", "size"], 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "ring_slot")
