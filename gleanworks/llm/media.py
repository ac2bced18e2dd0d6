"""Media columns: texts as lossless FLAC streams, back to PCM blocks with seekable sample offsets.

A payload is the text's UTF-8 bytes and bytes 255 up to a positive multiple of BLOCK; byte b is the
signed 8-bit sample b - 128. Every step maps rows alone, in groups of GROUP_BYTES, so memory does
not grow with the table; a single text beyond that is a group of its own. Nothing is shuffled.

Nulls: a null text is empty; a null id stays null. An empty text is one block of bytes 255. Equal
texts give equal streams. Damaged streams raise FlacError. Empty input: an empty result. Columns
other than the id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import groups, text_groups
from gleanworks.llm.flac import BLOCK, decode_streams, encode_streams, read_blocks
from gleanworks.session import table

GROUP_BYTES = 4 << 20


def padded(data: bytes) -> bytes:
    return data + b"\xff" * (-len(data) % BLOCK if data else BLOCK)


def encode_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lpc_order: int = 2) -> DataFrame:
    """(id, n_bytes, media): each text as a FLAC stream."""

    def encode(batches):
        for own, data in text_groups(batches, GROUP_BYTES):
            media = encode_streams([padded(d) for d in data], lpc_order)
            columns = [own["id"], pa.array([len(d) for d in data], pa.int64()), pa.array(media, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "media"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "id long, n_bytes long, media binary")


def _blocks(media: list[bytes], step: int):
    """For each stream its (sample offset, PCM) blocks of `step` samples, in order; frames and streams verified by their checksums."""
    for payload in decode_streams(media):
        pcm = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
        yield [(a, pcm[a : a + step]) for a in range(0, len(pcm), step)]


def pcm_blocks(media: DataFrame, blocks_a_row: int = 64) -> DataFrame:
    """(id, sample_offset, pcm): the decoded samples in rows of whole blocks, each seekable by its offset."""

    def cut(frames):
        for pdf in frames:
            for part in groups([len(m) for m in pdf["media"]], GROUP_BYTES):
                own = pdf.iloc[part]
                for i, blocks in zip(own["id"], _blocks(list(own["media"]), blocks_a_row * BLOCK)):
                    yield pd.DataFrame({"id": [i] * len(blocks), "sample_offset": [a for a, _ in blocks], "pcm": [x for _, x in blocks]})

    return media.select("id", "media").mapInPandas(cut, "id long, sample_offset long, pcm binary")


def samples_at(media: DataFrame, offset_col: str) -> DataFrame:
    """media with block_offset and pcm: the one block that holds the sample offset of each row, found by the seek table."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in media.schema) + ", block_offset long, pcm binary"

    def read(frames):
        for pdf in frames:
            for part in groups([len(m) for m in pdf["media"]], GROUP_BYTES):
                own = pdf.iloc[part]
                at = own[offset_col].astype(int).tolist()
                yield own.assign(block_offset=[a // BLOCK * BLOCK for a in at], pcm=read_blocks(list(own["media"]), at))

    return media.mapInPandas(read, schema)


def features(payload: bytes) -> str:
    """Mean, root mean square, peak and zero crossings of the samples."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"mean={x.mean():.4f} rms={np.sqrt((x * x).mean()):.4f} peak={int(np.abs(x).max())} crossings={crossings}"


def media_digest(media: DataFrame, blocks_a_row: int = 64) -> DataFrame:
    """Reads each stream back block by block, and its last block once more by its seek point; one row of sizes, digests and features for each."""

    def digest(frames):
        for pdf in frames:
            for part in groups([len(m) for m in pdf["media"]], GROUP_BYTES):
                own, out = pdf.iloc[part], []
                streams, sizes, read = list(own["media"]), [], []
                for blocks in _blocks(streams, blocks_a_row * BLOCK):
                    x = np.frombuffer(b"".join(pcm for _, pcm in blocks), np.uint8) ^ 0x80
                    read.append(x.tobytes())
                    sizes.append(len(x))
                last = read_blocks(streams, [n - 1 for n in sizes])
                for i, n, m, p, pcm in zip(own["id"], own["n_bytes"], streams, read, last):
                    tail = (np.frombuffer(pcm, np.uint8)[-32:] ^ 0x80).tobytes()
                    out.append((i, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(tail), len(m), hashlib.sha256(m).hexdigest(), features(p)))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.mapInPandas(digest, schema)


def op10_flac(spark, sf_dir):
    """Every document's text stored as FLAC, read back and digested."""
    return media_digest(encode_media(table(spark, sf_dir, "documents")))
