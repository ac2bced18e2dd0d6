"""Best-fit packing of token pieces into sequences, planned over the counts of lengths.

Texts become ids and an end id; longer documents are cut into pieces of CONTEXT. The planner gets
only the number of pieces of each length (CONTEXT numbers at any data size). It places lengths from
long to short, each into the open sequences with the least room that suffices, whole ranges of
sequences at once, and opens new ones when none suffices: best-fit decreasing. A range's room at
least halves with each visit and each length splits at most two ranges, so there are at most
11 x 3 x CONTEXT planned runs. Pieces take planned slots by their rank within their length.

Nulls: a null text is empty (the end id alone); a null doc_id stays null. Very long texts are cut,
never dropped. Repeated rows are packed each. Ties of length are ranked by doc_id and piece. Empty
input: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, hot_limit, literal_table, ranked, text_groups
from gleanworks.llm.tokens import encoder
from gleanworks.session import table

TOKENIZER = "word_bpe_49k.json"
CONTEXT = 2048
END_ID = 0
GROUP_BYTES = 1 << 20
RUN = "length int, first long, last long, sequence long, each long, at long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, path: str, context: int = CONTEXT, end_id: int = END_ID, ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): pieces of at most context ids; ids as little-endian 32-bit numbers."""
    end = np.array([end_id], "<u4").tobytes()

    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if ids else {})

    def cut(batches):
        encode = encoder(path).encode
        for own, texts in text_groups(batches, GROUP_BYTES):
            rows = []
            for doc, data in zip(own["doc_id"].to_pylist(), encode([t.decode(errors="replace") for t in texts])):
                data += end
                for piece, a in enumerate(range(0, len(data), 4 * context)):
                    part = data[a : a + 4 * context]
                    rows.append((doc, piece, a // 4, len(part) // 4, zlib.crc32(part), part))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], list(kinds))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], context: int = CONTEXT) -> list[dict]:
    """Runs: ranks first..last-1 of a length go to consecutive sequences from `sequence`, `each` to one, from offset `at` on."""
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: ranges (first sequence, number)
    opened, runs = 0, []
    for length in sorted(counts, reverse=True):
        left, rank, space = counts[length], 0, length
        while left:
            while space <= context and not room[space]:
                space += 1
            if space > context:
                number = -(-left // (context // length))
                room[space := context].append((opened, number))
                opened += number
            first, number = room[space].pop()
            each = space // length
            full = min(number, left // each)
            if full:
                runs.append({"length": length, "first": rank, "last": rank + full * each, "sequence": first, "each": each, "at": context - space})
                room[space - each * length].append((first, full))
                rank, left = rank + full * each, left - full * each
            if full < number and left and left < each:  # the last few share one sequence
                runs.append({"length": length, "first": rank, "last": rank + left, "sequence": first + full, "each": left, "at": context - space})
                room[space - left * length].append((first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < number:
                room[space].append((first + full, number - full))
    return runs


def pack(pieces: DataFrame, context: int = CONTEXT) -> DataFrame:
    """pieces(doc_id, piece, length, ids_crc32, ...) with sequence_id and offset, in place of columns of those names."""
    pieces = durable(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, n_rows = literal_table(pieces.sparkSession, plan(counts, context), RUN), sum(counts.values())
    hot = [{"length": k, "n": n} for k, n in counts.items() if n > hot_limit(n_rows)]
    # The caller's columns go along in a struct, so that none of their names can clash.
    held = pieces.select(F.struct(*(F.col(f"`{c}`") for c in pieces.columns)).alias("_row"), F.col("length").cast("int").alias("length"), "doc_id", "piece", "ids_crc32")
    rows = ranked(held, ["length"], ["doc_id", "piece", "ids_crc32"], hot, n_rows)
    placed = rows.join(F.broadcast(runs), "length").where("rank >= first AND rank < last")
    nth = F.col("rank") - F.col("first")
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.floor(nth / F.col("each")).cast("long"))
    placed = placed.withColumn("offset", F.col("at") + nth % F.col("each") * F.col("length"))
    return placed.select(*(F.col(f"_row.`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")), "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids) from placed pieces that carry ids: whole sequences of at most CONTEXT ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda held, p: F.concat(held, p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_path()))


def op2_best_fit_pack(spark, sf_dir):
    """All documents packed into sequences of at most 2048 ids."""
    return packed_documents(table(spark, sf_dir, "documents"))
