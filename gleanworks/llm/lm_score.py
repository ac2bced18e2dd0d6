"""Cross-entropy difference: bigram models of a target and of the background text score documents.

Both models share a vocabulary (all words of target and background, a start sign and one sign for
words of neither), their order and their smoothing. A document's score is the mean over its words
of target loss minus background loss, in nats: the lower, the more the text is like the target.

1. Words are counted as such and as contexts: a table (word, n and c of each text kind).
2. Pairs that occur HOT times among the documents or more, and are one of HOT_KEYS of all or more, are
   counted alone, by partial sums over the hot words; their losses go to every task. There are at most
   HOT_KEYS of them at any size.
3. All other pairs, summed for each document, are dealt to buckets of about BUCKET_BYTES of text by
   their context's hash (by the pair's for hot contexts), as are those of the target and background. A bucket asks the word table for its words,
   counts its pairs, and sums their losses for each document.
4. A document is in one flush of a task; the buckets' sums are added up flush by flush, in units of 1 / UNIT
   nats: the same on any layout.

All tables grow with the texts; the driver gets totals, hot words and hot pairs only. Words and
pairs are known by 64-bit hashes, so they are told apart up to collisions. With a `size`, only the
size - 2 commonest words are told apart (ties by the word's hash).

Nulls: a null text has no words; texts without words have null losses and score. Very long texts
are scored whole. Repeated rows count and score each. Without any target text the target model is
uniform over the vocabulary. Empty input: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import stored, text_groups
from gleanworks.llm.shingles import GROUP_BYTES, mixed, word_hashes
from gleanworks.session import table

#: Codes that stand for no word of their own.
OTHER, START = np.uint64(0), np.uint64(1)
#: Share of a pair's own frequency in its probability; the rest is the word's.
OWN = 0.7
FLUSH = 1_000_000
DEALT = 600_000
BUCKET_BYTES, LEAST_BUCKETS, BUCKETS_A_TASK = 8_000_000, 8, 4
#: A word or pair is hot from so many occurrences on and from this share of all, so at most HOT_KEYS are.
HOT, HOT_KEYS = 200_000, 1 << 16
UNIT = 1 << 30
#: Kinds of text; a bucket's rows of kind ROWS name the documents themselves.
TARGET, BACKGROUND, DOCS, ROWS = range(4)
COUNTS = ("n0", "c0", "n1", "c1", "n2", "c2")


def _word_batches(batches):
    """(rows, word hashes, words a row) for groups of texts."""
    for own, texts in text_groups(batches, GROUP_BYTES):
        yield own, *word_hashes(texts)


def _batch(columns: dict, kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds.items()], list(kinds))


def _packed(values) -> list[bytes]:
    """Binary values by zstandard: what is dealt is most of the shuffle, and Spark's own codec is a quick one."""
    codec = zstandard.ZstdCompressor(level=3)
    return [codec.compress(v) for v in values]


def _read(column: pa.ChunkedArray, dtype) -> Iterator[np.ndarray]:
    """Each packed value as numbers, one at a time."""
    codec = zstandard.ZstdDecompressor()
    return (np.frombuffer(codec.decompress(v.as_buffer()), dtype) for chunk in column.chunks for v in chunk)


def _signed(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes).view(np.int64)


def _coded(frames, known):
    """(rows, code before each word, code of each word, words a row); each text begins after START."""
    for own, words, counts in _word_batches(frames):
        if known is not None:
            words = np.where(np.isin(words, known), words, OTHER)
        before = np.concatenate([[START], words[:-1]]) if len(words) else words
        first = np.cumsum(counts) - counts
        before[first[counts > 0]] = START
        yield own, before, words, counts


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) * np.uint64(0x9E3779B97F4A7C15) + words)


def _place(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where the codes are in the sorted known ones; len(known) for others."""
    if not len(known):
        return np.zeros(len(codes), np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, at, len(known))


def vocabulary(texts: DataFrame, size: int) -> np.ndarray:
    """The sorted hashes of the size - 2 commonest words of texts(text)."""
    words = _word_rows(texts, None).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    top = words.orderBy(F.col("n").desc(), "word").limit(size - 2)
    return np.sort(np.array([r["word"] for r in top.collect()], np.int64).view(np.uint64))


def _word_rows(texts: DataFrame, known) -> DataFrame:
    """(word, n, c) of texts(text): how often a word occurs and comes before another; sums of bounded flushes."""

    def rows(frames):
        held, total = [], 0

        def flush():
            codes, n = np.unique(np.concatenate([w for w, _ in held]), return_counts=True)
            last = np.concatenate([x for _, x in held])
            c = n - np.bincount(np.searchsorted(codes, last), minlength=len(codes))
            return _batch({"word": _signed(np.append(codes, START)), "n": np.append(n, 0), "c": np.append(c, len(last))}, {x: pa.int64() for x in ("word", "n", "c")})

        for _, _, words, counts in _coded(frames, known):
            held.append((words, words[np.cumsum(counts)[counts > 0] - 1]))
            total += len(words)
            if total >= FLUSH:
                yield flush()
                held, total = [], 0
        if total:
            yield flush()

    return texts.mapInArrow(rows, "word long, n long, c long")


def word_table(texts: dict[int, DataFrame], known) -> DataFrame:
    """(word, n0, c0, n1, c1, n2, c2): _word_rows of each kind of texts(text)."""
    out = None
    for kind, own in texts.items():
        named = {f"{x}{kind}": F.col(x) for x in "nc"}
        rows = _word_rows(own, known).select("word", *(named.get(c, F.lit(0).cast("long")).alias(c) for c in COUNTS))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))


def losses(pair, context, word, total: int, size: int, own: float = OWN) -> np.ndarray:
    """-log p(word | previous word): the pair's frequency and the word's, each word counted once more."""
    p = (word + 1.0) / (total + size)
    return -np.log(np.where(context > 0, own * pair / np.maximum(context, 1) + (1 - own) * p, p))


def hot_pairs(texts: dict[int, DataFrame], known, hot: np.ndarray, most: int) -> pd.DataFrame:
    """(a, b, p0, p1, p2): counts of each kind, of the pairs of hot words that texts of the last kind hold `most` times."""

    def rows_of(kind):
        def rows(frames):
            for _, before, words, _ in _coded(frames, known):
                a, b = _place(before, hot), _place(words, hot)
                both = (a < len(hot)) & (b < len(hot))
                codes, n = np.unique(a[both] * len(hot) + b[both], return_counts=True)
                out = {"a": _signed(hot[codes // len(hot)]), "b": _signed(hot[codes % len(hot)])}
                out |= {f"p{k}": n if k == kind else 0 * n for k in (TARGET, BACKGROUND, DOCS)}
                yield _batch(out, {c: pa.int64() for c in out})

        return texts[kind].mapInArrow(rows, "a long, b long, p0 long, p1 long, p2 long")

    out = None
    for kind in texts:
        out = rows_of(kind) if out is None else out.unionByName(rows_of(kind))
    sums = out.groupBy("a", "b").agg(*(F.sum(f"p{k}").alias(f"p{k}") for k in (TARGET, BACKGROUND, DOCS)))
    return sums.where(F.col(f"p{max(texts)}") >= most).toPandas()


def _pair_losses(pairs, contexts, words, totals, size) -> list[np.ndarray]:
    """Losses under both models, in units; each argument has the target's figures, then the background's."""
    return [np.rint(losses(p, c, n, t, size) * UNIT).astype(np.int64) for p, c, n, t in zip(pairs, contexts, words, totals)]


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


DEALT_ROWS = "target long, kind int, base long, words binary, a binary, b binary, docs binary, doc binary, n binary"


DEALT_KINDS = {"target": pa.int64(), "kind": pa.int32(), "base": pa.int64()} | {c: pa.binary() for c in ("words", "a", "b", "docs", "doc", "n")}


def _dealt(texts: DataFrame, kind: int, known, hot, buckets: int) -> DataFrame:
    """Pairs that are not hot, by bucket, with the documents they are of; for kind DOCS also rows of the documents."""

    def rows(frames):
        hot_words, keys, *hot_losses = hot.value
        task = TaskContext.get().partitionId()
        held, total, seen = [], 0, 0

        def flush(first):
            counts = np.concatenate([c for *_, c in held]).astype(np.int64)
            before, words = np.concatenate([b for _, b, _, _ in held]), np.concatenate([w for *_, w, _ in held])
            ids = pa.chunked_array([r["doc_id"] for r, *_ in held], pa.int64()) if kind == DOCS else None
            held.clear()
            doc = np.repeat(np.arange(len(counts), dtype=np.uint32), counts) if kind == DOCS else np.zeros(len(words), np.uint32)
            key = pair_keys(before, words)
            at, base = _place(key, keys), (task << 33) + first
            out = []
            if kind == DOCS:
                null = ids.is_null().to_numpy()
                done = at < len(keys)
                sums = [_sums(doc[done], x[at[done]], len(counts)).tobytes() for x in hot_losses]
                out.append((-1 - task, ROWS, base, ids.fill_null(0).to_numpy().tobytes(), null.tobytes(), counts.tobytes(), b"", *sums))
            rest = at == len(keys)
            before, words, doc, key = before[rest], words[rest], doc[rest], key[rest]
            # Pairs of a context share a bucket, so that it is named and asked for once; those of a hot one are parted.
            spread = np.where(_place(before, hot_words) < len(hot_words), key, mixed(before))
            bucket = ((spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(_width(buckets))
            order = np.argsort(words, kind="stable")  # by bucket, context and word, documents in order
            for by in (before, bucket):
                order = order[np.argsort(by[order], kind="stable")]
            before, words, doc, bucket = before[order], words[order], doc[order], bucket[order]
            del at, rest, order, spread, key
            if len(words):
                new = np.concatenate([[True], (words[1:] != words[:-1]) | (before[1:] != before[:-1])])
                once = np.flatnonzero(new | np.concatenate([[True], doc[1:] != doc[:-1]]))
                n = np.diff(np.append(once, len(doc)))
                doc, first = doc[once], np.flatnonzero(new[once])
                before, words, bucket = before[new], words[new], bucket[new]
                ends = np.append(first, len(once))
                cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
                for i, j in zip(cuts[:-1], cuts[1:]):
                    own, place = np.unique(np.concatenate([before[i:j], words[i:j]]), return_inverse=True)
                    entries = slice(ends[i], ends[j])
                    sizes = (np.diff(ends[i : j + 1]), doc[entries], n[entries])
                    out.append((int(bucket[i]), kind, base, _planes(own, False), *(_planes(x) for x in (place[: j - i], place[j - i :], *sizes))))
            columns = dict(zip(DEALT_KINDS, zip(*out) if out else [[]] * len(DEALT_KINDS)))
            return _batch({c: _packed(v) if DEALT_KINDS[c] == pa.binary() else v for c, v in columns.items()}, DEALT_KINDS)

        for batch in _coded(frames, known):
            held.append(batch)
            total += len(batch[2])
            if total >= DEALT:
                more = sum(len(c) for *_, c in held)
                yield flush(seen)
                seen, total = seen + more, 0
        if held:
            yield flush(seen)

    return texts.mapInArrow(rows, DEALT_ROWS)


#: What a bucket tells of a flush of documents: sums by place in it; and what the flush tells of its documents.
SUMMED = ("base", "ids", "null", "n", "doc", "t0", "t1")


def _width(n: int):
    return np.uint16 if n <= 1 << 16 else np.uint32


def _planes(x: np.ndarray, small: bool = True) -> bytes:
    """Numbers under 2^32, or else of 64 bits: all their lowest bytes first, as the high ones compress."""
    x = x if x.dtype in (np.uint64, np.int64) and not small else x.astype("<u4")
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unplaned(data: np.ndarray, kind="<u4") -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0]


def score_texts(docs: DataFrame, target: DataFrame, background: DataFrame, size: int | None = None) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of docs(doc_id, text); the others are (text).

    Where the background is docs itself, its pairs are dealt once."""
    sc, same = docs.sparkSession.sparkContext, background is docs
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    texts = {TARGET: target.select(text)} | ({} if same else {BACKGROUND: background.select(text)}) | {DOCS: rows}
    n_bytes = sum(t.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0 for t in texts.values())
    buckets = max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES))
    known = None if size is None else vocabulary(target.select("text").unionByName(background.select("text")), size)

    words = stored(word_table({k: t.select("text") for k, t in texts.items()}, known))
    if same:
        words = words.withColumns({"n1": F.col("n2"), "c1": F.col("c2")})
    facts = words.agg(F.count_if(F.col("n0") + F.col("n1") > 0).alias("v"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.sum("n2").alias("t2")).first()
    size, totals = size or facts["v"] + 2, (facts["t0"] or 0, facts["t1"] or 0)

    most = max(HOT, (facts["t2"] or 0) // HOT_KEYS)
    hot = words.where(F.greatest("n2", "c2") >= most).toPandas().sort_values("word")
    hot_words, keys, hot_losses = np.sort(hot["word"].to_numpy(np.int64).view(np.uint64)), np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * 2
    if len(hot):
        pairs = hot_pairs({k: t.select("text") for k, t in texts.items()}, known, hot_words, most)
        if same:
            pairs["p1"] = pairs["p2"]
        hot = hot.set_index("word")
        a, b = hot.loc[pairs["a"]], hot.loc[pairs["b"]]
        keys = pair_keys(*(pairs[x].to_numpy(np.int64).view(np.uint64) for x in "ab"))
        order = np.argsort(keys)
        found = _pair_losses(*([d[c].to_numpy() for c in own] for d, own in ((pairs, ("p0", "p1")), (a, ("c0", "c1")), (b, ("n0", "n1")))), totals, size)
        keys, hot_losses = keys[order], [x[order] for x in found]
    shared = sc.broadcast((hot_words, keys, *hot_losses))

    dealt = None
    for kind, own in texts.items():
        part = _dealt(own, kind, known, shared, buckets)
        dealt = part if dealt is None else dealt.unionByName(part)

    def wanted(t):
        own = [_unplaned(x, np.uint64) for x, kind in zip(_read(t["words"], np.uint8), t["kind"].to_pylist()) if kind != ROWS]
        codes = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        return pa.table({"target": np.full(len(codes), t["target"][0].as_py(), np.int64), "word": _signed(codes)})

    def score(key, t, facts):
        kinds = {"base": pa.int64()} | {c: pa.binary() for c in SUMMED[1:]}
        bases, parts = t["base"].to_pylist(), []
        if key[0].as_py() < 0:  # the documents themselves go on as they are
            columns = (bases, *(t[c].to_pylist() for c in ("words", "a", "b")), [None] * len(bases), t["doc"].to_pylist(), t["n"].to_pylist())
            return pa.Table.from_batches([_batch(dict(zip(SUMMED, columns)), kinds)])
        known_words = facts["word"].to_numpy().view(np.uint64)
        order = np.argsort(known_words)
        known_words = known_words[order]
        stats = {c: np.append(facts[c].to_numpy()[order], int(same and c[1] == "1")) for c in ("n0", "c0", "n1", "c1")}  # words not told of last
        raw = (_read(t[c], np.uint8) for c in ("a", "b", "docs", "doc", "n"))
        for base, kind, own, a, b, docs_, doc, n in zip(bases, t["kind"].to_pylist(), _read(t["words"], np.uint8), *raw):
            own = _unplaned(own, np.uint64)
            at = _place(own, known_words)
            a, b = (at[_unplaned(x)] for x in (a, b))
            pair, n = np.repeat(a * (len(known_words) + 1) + b, _unplaned(docs_)), _unplaned(n)
            parts.append((pair, n, np.full(len(n), kind, np.int8), base + _unplaned(doc).astype(np.int64)))
        pair, n, kind, ref = (np.concatenate(x) for x in zip(*parts))
        del parts
        pairs, at = np.unique(pair, return_inverse=True)
        a, b = pairs // (len(known_words) + 1), pairs % (len(known_words) + 1)
        counts = [np.bincount(at, np.where(kind == k, n, 0), len(pairs)) for k in (TARGET, DOCS if same else BACKGROUND)]
        if same:  # a pair of a lone word is as lone
            lone = (a == len(known_words)) | (b == len(known_words))
            counts = [np.where(lone, x, c) for x, c in enumerate(counts)]
        found = _pair_losses(counts, (stats["c0"][a], stats["c1"][a]), (stats["n0"][b], stats["n1"][b]), totals, size)
        at, n, ref = at[kind == DOCS], n[kind == DOCS].astype(np.int64), ref[kind == DOCS]
        refs, row = np.unique(ref, return_inverse=True)
        sums = [_sums(row, x[at] * n, len(refs)) for x in found]
        # A row for each flush of documents, as there is a document for each of its pairs.
        starts = np.unique(np.array(bases, np.int64))
        cuts = np.append(np.searchsorted(refs, starts), len(refs))
        own = [(int(b), i, j) for b, i, j in zip(starts, cuts[:-1], cuts[1:]) if i < j]
        docs_ = _packed(_planes(refs[i:j] - b) for b, i, j in own)
        told_ = [_packed(_planes(x[i:j], False) for _, i, j in own) for x in sums]
        columns = ([b for b, *_ in own], *([[None] * len(own)] * 3), docs_, *told_)
        return pa.Table.from_batches([_batch(dict(zip(SUMMED, columns)), kinds)])

    def total(t):
        rows = [r["ids"] is not None for r in t.select(["ids"]).to_pylist()]
        head, rest = t.filter(pa.array(rows)), t.filter(pa.array([not r for r in rows]))
        ids, null, n = (next(_read(head[c], kind)) for c, kind in (("ids", np.int64), ("null", bool), ("n", np.int64)))
        sums = [next(_read(head[c], np.int64)).copy() for c in ("t0", "t1")]
        for doc, *more in zip(*(_read(rest[c], np.uint8) for c in ("doc", "t0", "t1"))):
            doc = _unplaned(doc)
            for s, x in zip(sums, more):
                s[doc] += _unplaned(x, np.int64)  # a document stands once in a row
        return pa.table({"doc_id": pa.array(ids, mask=null), "n_words": n, "t0": sums[0], "t1": sums[1]})

    # As many partitions as the data asks for: a task's share does not grow with them.
    dealt = dealt.repartition(max(1, buckets // BUCKETS_A_TASK), "target")
    asked = dealt.groupBy("target").applyInArrow(wanted, "target long, word long")
    facts = words.select("word", "n0", "c0", "n1", "c1")
    if same:  # of words that occur once in all texts, and are no text's last, nothing is told
        facts = facts.where("NOT (n0 = 0 AND c0 = 0 AND n1 = 1 AND c1 = 1)")
    told = asked.join(facts, "word").select("target", "word", "n0", "c0", "n1", "c1")
    parts = dealt.groupBy("target").cogroup(told.repartition(max(1, buckets // BUCKETS_A_TASK), "target").groupBy("target")).applyInArrow(score, "base long, " + ", ".join(f"{c} binary" for c in SUMMED[1:]))
    out = parts.groupBy("base").applyInArrow(total, "doc_id long, n_words long, t0 long, t1 long")
    mean = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words") / UNIT)
    out = out.select("doc_id", "n_words", mean("t0").alias("target_loss"), mean("t1").alias("background_loss"))
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op5_cross_entropy_difference(spark, sf_dir):
    """Every document's loss under a model of the benchmark's texts, against one of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, table(spark, sf_dir, "benchmark").select("text"), docs)
