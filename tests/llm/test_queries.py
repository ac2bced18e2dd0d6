"""The registered queries against their SQL or their form, and the pipeline against brute force."""

import base64
import hashlib
import math
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path[:0] = [os.path.dirname(__file__), os.path.dirname(os.path.dirname(__file__))]

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from gleanworks.llm import media, token_counts  # noqa: E402
from gleanworks.llm.queries import ORACLES, QUERIES  # noqa: E402
from gleanworks.session import table  # noqa: E402
from oracle import check  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, name):
    check(spark, sf_dir, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op7_section_tokens", "op2_best_fit_pack", "op8_ring_shards", "op10_flac"}))
def test_a_row_for_each_document(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).select("doc_id").distinct().count() == table(spark, sf_dir, "documents").count()


def test_media_by_plain_digests(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op10_flac"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    encoded = {r["id"]: bytes(r["media"]) for r in media.encode_media(table(spark, sf_dir, "documents")).collect()}
    for n, r in enumerate(rows):
        data = texts[r["doc_id"]].encode()
        payload = data + b"\xff" * (-len(data) % 576 if data else 576)
        m = encoded[r["doc_id"]]
        got = (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"])
        assert got == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest())
        if n < 25 and len(payload) < 20_000:
            x = brute.flac_samples(m)
            assert bytes(v + 128 for v in x) == payload
            mean, rms = sum(x) / len(x), math.sqrt(sum(v * v for v in x) / len(x))
            crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
            assert r["feature"] == f"mean={mean:.4f} rms={rms:.4f} peak={max(map(abs, x))} crossings={crossings}"


def test_sections_by_the_tokenizers_own_offsets(spark, sf_dir):
    import tiktoken
    import public_tokenizers

    with open(token_counts.ranks_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {}
    for r in QUERIES["op7_section_tokens"](spark, sf_dir).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = (r["start"], r["stop"], r["n_tokens"])
    for r in table(spark, sf_dir, "documents").collect():
        text = r["text"] or ""
        lines = text.splitlines(keepends=True) if set(text) <= set(map(chr, range(32, 127))) | {"\n"} else [x + "\n" for x in text.split("\n")[:-1]] + [text.split("\n")[-1]] * (not text.endswith("\n"))
        lines, want, at = lines or [""], {}, 0
        spots = enc.decode_with_offsets(enc.encode_ordinary(text))[1]
        for i, line in enumerate(lines):
            want[i] = (at, at + len(line), sum(at <= s < at + len(line) for s in spots))
            at += len(line)
        assert got[r["doc_id"]] == want


def test_shards_by_a_plain_walk(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    want = brute.ring_places([r["doc_id"] for r in docs], 8)
    rows = {r["doc_id"]: r for r in QUERIES["op8_ring_shards"](spark, sf_dir).collect()}
    slots = {}
    for x, d in enumerate(docs):
        r, data = rows[d["doc_id"]], (d["text"] or "").encode()
        assert (r["shard"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (want[x], len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_pipeline_cases(spark, sf_dir):
    """Empty and odd tables, with names that the stages use themselves, go through all stages."""
    rows = [(1, "one two three four five six", "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "null id here", "en", None, 2), (6, "tie tie", "en", "t", 1), (6, "tie tie", "en", "t", 1), (8, "one two three four five six", "en", "é", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ("copies", "score", "predicted", "group", "entity", "_row", "_id", "_tie", "_nth", "_mark", "rank", "size", "length", "offset")
    for docs in (df, df.withColumns({c: F.lit("mine") for c in names}), df.limit(0)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, kept = kept, stage(spark, kept, sf_dir)
            assert kept.columns == before.columns, name
        found = kept.collect()
        assert all(r["copies"] == "mine" for r in found if "copies" in kept.columns)
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
        assert len(packed) == len(found) and {r["doc_id"] for r in packed} == {r["doc_id"] for r in found} and 8 not in {r["doc_id"] for r in packed}


def test_pipeline(spark, sf_dir, tmp_path):
    docs, kept = table(spark, sf_dir, "documents"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
    rows = [(r["doc_id"], r["text"]) for r in kept["toxicity"].collect()]
    want = {d for d, (_, c) in brute.near_groups(rows).items() if d == c}
    assert sorted(r["doc_id"] for r in kept["ngram_join"].collect()) == sorted(want)
    assert {r["doc_id"] for r in kept["packing"].select("doc_id").collect()} == {r["doc_id"] for r in kept["mixing"].select("doc_id").collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == kept["packing"].count()
