"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Two dictionaries of equal size are trained by zstandard's trainer, one on passages of toxic, one on
passages of ordinary labelled texts. Of what the trainer chose, each keeps the parts that are far
likelier in its own class: runs of GRAM-byte strings whose different surroundings in the passages
(so copies count once) differ between the classes by odds and by evidence. Every text is cut into
overlapping windows of WINDOW words, a new one each STEP words; a window is compressed with each
dictionary, and the gap is how much shorter the toxic one makes it. Both dictionaries end in one
anchor that stands before each window, so a window's block always holds a match and any further
match shows in its length. How many windows reach each threshold of the gap, below zero too, with
the number of windows, gives the score by a logistic calibration fitted on labelled texts that these
dictionaries have not seen. Scoring takes whole texts, row by row; nothing is shuffled.

Sample: at most 2 x SAMPLE texts a class, of any length, chosen by a hash of the id. Three fifths of
them, by another hash, train the dictionaries: at most PASSAGES passages of PASSAGE_BYTES a class,
chosen by hash from all places of the texts, reach the driver. The rest calibrate: their features are
computed where the texts are, and the driver gets only those.

Nulls: a null text scores as an empty one, which has one empty window; a null label or id is never
sampled. Several labels of one id count as their largest; of several texts of one id, the one of
the least hash is learnt from. Repeated rows score alike. With labels of one class only, or none,
every text has the score BLIND. Empty input: an empty result. `scored` replaces columns of the
names that it is told to write (`score` and `predicted` unless told otherwise); `without_toxic`
returns the caller's columns as they are, whatever their names.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, groups
from gleanworks.llm.shingles import mixed
from gleanworks.session import table

THRESHOLD = 0.3
SAMPLE = 2000
PASSAGES, PASSAGE_BYTES = 4000, 1200
#: Partitions of the sample, whose texts come from limits and so from one task each.
PARTS = 32
#: Words in a window, and from one window's start to the next's; longer words are cut.
WINDOW, STEP, WORD_BYTES = 4, 2, 32
TRAINED_BYTES, DICTIONARY_BYTES = 32_768, 8192
#: Parameters of the trainer: bytes that must repeat, and bytes of a segment.
TRAIN_D, TRAIN_K = 8, 16
#: A string of GRAM bytes is a class's own if it is so many times (e^2) likelier there, by such a log-likelihood ratio.
GRAM, LEAST_ODDS, LEAST_EVIDENCE = 7, 2.0, 15.0
#: Share of the count of the best overlapping string that a string needs to be kept.
CORE = 0.7
AROUND = 8
ANCHOR = bytes(range(1, 25))
GAPS, BELOW = tuple(range(1, 13)), (1, 2, 3, 5)
BLIND = 0.0
GROUP_BYTES = 1 << 20
WORDS = re.compile(rb"[^\x00-\x20]{1,%d}" % WORD_BYTES)


def lowered(texts: pa.Array) -> list[bytes]:
    """Lower-cased UTF-8 of a string array; null is empty."""
    return [t or b"" for t in pc.utf8_lower(texts).cast(pa.large_binary()).to_pylist()]


def windows(text: bytes, size: int = WINDOW, step: int = STEP) -> list[bytes]:
    """Overlapping windows over the words of a lower-cased text; one empty window without any."""
    own = WORDS.findall(text)
    return [b" ".join(own[i : i + size]) for i in range(0, max(1, len(own) - size + step), step)]


def grams(data: bytes) -> np.ndarray:
    """All strings of GRAM bytes, as numbers."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = max(len(b) - GRAM + 1, 0)
    return sum((b[j : j + n] << np.uint64(8 * j) for j in range(GRAM)), np.zeros(n, np.uint64))


def surroundings(passages: list[bytes], known: np.ndarray) -> tuple[np.ndarray, int]:
    """For each of the sorted known strings the number of different bytes around it, and the bytes of all passages."""
    edge, held, seen, total = b"\0" * AROUND, [], [], 0
    for part in groups([len(p) for p in passages], GROUP_BYTES):
        data = edge + b"\0".join(passages[part]) + edge
        total += len(data)
        x = grams(data)[AROUND : len(data) - AROUND - GRAM + 1]
        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
        spots = np.flatnonzero(known[at] == x)
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), AROUND)
        left, right = (np.ascontiguousarray(view[spots + d]).view(np.uint64)[:, 0] for d in (0, AROUND + GRAM))
        held.append(at[spots])
        seen.append(mixed(mixed(left) + mixed(right) * np.uint64(3) + x[spots]))
    first = np.unique(np.concatenate(seen), return_index=True)[1] if seen else np.zeros(0, np.int64)
    return np.bincount(np.concatenate(held)[first] if held else first, minlength=len(known)), total


def dictionary(own: list[bytes], other: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """What zstandard's trainer takes from the class's passages, without the parts that are not the class's own; the commonest last."""
    trained = train(own)
    codes = grams(trained)
    if not len(codes):
        return b""
    known, place = np.unique(codes, return_inverse=True)
    (a, n_own), (b, n_other) = surroundings(own, known), surroundings(other, known)
    odds = np.log((a + 0.5) / (n_own + 1)) - np.log((b + 0.5) / (n_other + 1))
    expect = (a + b) * (n_own + 1) / (n_own + n_other + 2)
    log = lambda n, e: np.where(n > 0, n * np.log(np.maximum(n, 1) / np.maximum(e, 1e-9)), 0.0)
    evidence = 2 * (log(a, expect) + log(b, a + b - expect))
    n = np.where((odds >= LEAST_ODDS) & (evidence >= LEAST_EVIDENCE), a, 0)[place]
    best = np.lib.stride_tricks.sliding_window_view(np.pad(n, GRAM - 1), 2 * GRAM - 1).max(1)
    mark = np.zeros(len(trained) + 2, np.int8)
    for i in np.flatnonzero((n > 0) & (n >= CORE * best)) + 1:
        mark[i : i + GRAM] = 1
    edges, runs = np.flatnonzero(np.diff(mark)), {}
    for i, j in zip(edges[::2], edges[1::2]):
        runs[trained[i:j]] = max(runs.get(trained[i:j], 0), int(n[i : j - GRAM + 1].max()))
    out = b""
    for run in sorted(runs, key=lambda r: (-runs[r], r)):
        if run not in out and len(out) + len(run) < size:
            out = b"\n" + run + out
    return out


def train(passages: list[bytes]) -> bytes:
    """The content of a dictionary that zstandard trains on the passages; all of them where they are too few to train on."""
    import zstandard as zs

    order = list(passages)
    random.Random(1).shuffle(order)
    try:
        return zs.train_dictionary(TRAINED_BYTES, [b" " + p + b" " for p in order], d=TRAIN_D, k=TRAIN_K).as_bytes()
    except zs.ZstdError:
        return b" ".join(order)[-TRAINED_BYTES:]


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None

    def compressors(self):
        import zstandard as zs

        params = zs.ZstdCompressionParameters.from_level(
            3, min_match=5, strategy=zs.STRATEGY_DFAST, window_log=17, hash_log=15, chain_log=15,
            format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        size, made = max(len(self.ordinary), len(self.toxic)), []
        for own in (self.ordinary, self.toxic):
            d = zs.ZstdCompressionDict(own.rjust(size, b"\n") + ANCHOR, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            made.append(zs.ZstdCompressor(dict_data=d, compression_params=params).compress)
        return made

    def gaps(self, text: bytes) -> np.ndarray:
        """Per window of a lower-cased text: its length with the ordinary dictionary less that with the toxic one."""
        if "_made" not in self.__dict__:  # one for all batches of a task
            self._made = self.compressors()
        ordinary, toxic = self._made
        parts = [b"%b %b " % (ANCHOR, w) for w in windows(text)]
        return np.array([len(ordinary(p)) - len(toxic(p)) for p in parts])

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: how many windows reach each gap, above and below zero, and how many there are."""
        rows = []
        for text in texts:
            g = self.gaps(text)
            counts = np.bincount(np.clip(g, -BELOW[-1], GAPS[-1]) + BELOW[-1], minlength=GAPS[-1] + BELOW[-1] + 1)
            over, under = counts[::-1].cumsum()[::-1], counts.cumsum()
            h, less = over[[x + BELOW[-1] for x in GAPS]], under[[BELOW[-1] - x for x in BELOW]]
            rows.append(np.concatenate([np.log1p(h), np.log1p(less), np.minimum(h, 6) / 2, [math.log(len(g))]]))
        return np.array(rows).reshape(len(rows), 2 * len(GAPS) + len(BELOW) + 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), BLIND)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + self.features(texts) @ self.weights[1:], -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the constant first) of a ridge logistic regression, by Newton steps."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    a = np.concatenate([np.ones((len(x), 1)), (x - mean) / spread], 1)
    penalty, w = np.diag([0.0] + [ridge] * x.shape[1]), np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (weight * (p - y)) + penalty @ w
        w = w - np.linalg.solve((a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + penalty, slope)
    return np.concatenate([[w[0] - (w[1:] * mean / spread).sum()], w[1:] / spread])


def held_out(id_col: str | Column) -> Column:
    """True for the ids whose CRC-32, as text, leaves 2 on division by 4: never learnt from."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(toxic, fold, text) of at most 2 x sample labelled texts a class, outside the held-out fold; fold 0 is for dictionaries, 1 for calibration."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_toxic"))
    known = known.select(F.col(id_col).alias("_id"), (F.col("_toxic") > 0).cast("int").alias("_toxic"))
    texts, out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")), None
    for toxic in (1, 0):
        # At most 3 x sample ids, some for texts that are absent.
        picked = known.where(F.col("_toxic") == toxic).orderBy(F.xxhash64("_id"), "_id").limit(3 * sample)
        one = F.min(F.struct(F.xxhash64("_text").alias("h"), "_text"))["_text"]
        found = texts.join(F.broadcast(picked), "_id").groupBy("_id").agg(one.alias("text")).orderBy(F.xxhash64("_id"), "_id").limit(2 * sample)
        found = found.select(F.lit(toxic).alias("toxic"), (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(5)) >= 3).cast("int").alias("fold"), "text")
        out = found if out is None else out.unionByName(found)
    return durable(out.repartition(PARTS))


def passages(texts: DataFrame, most: int = PASSAGES) -> dict[int, list[bytes]]:
    """For each class at most so many passages, by hash, of all that the texts(toxic, text) hold."""

    def cut(batches):
        for batch in batches:
            for part in groups(pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist(), GROUP_BYTES):
                own = batch.slice(part.start, part.stop - part.start)
                rows = [(x, t[i : i + PASSAGE_BYTES]) for x, t in zip(own["toxic"].to_pylist(), map(_plain, lowered(own["text"]))) for i in range(0, len(t), PASSAGE_BYTES)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary()))], ["toxic", "data"])

    made = durable(texts.mapInArrow(cut, "toxic int, data binary").distinct())
    by_hash = lambda toxic: made.where(F.col("toxic") == toxic).orderBy(F.xxhash64("data"), "data").limit(most)
    return {toxic: [bytes(r[0]) for r in by_hash(toxic).select("data").collect()] for toxic in (1, 0)}


def _plain(text: bytes) -> bytes:
    return b" ".join(WORDS.findall(text))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """A model from labelled documents outside the held-out fold."""
    texts = sampled(docs, labels, id_col, text_col, label_col, sample)
    parts = passages(texts.where("fold = 0"))
    if not all(parts.values()):
        return ToxicityModel(b"", b"")
    model = dictionaries(parts[1], parts[0])
    made = ToxicityModel(model.toxic, model.ordinary)

    def measure(batches):
        for batch in batches:
            for part in groups(pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist(), GROUP_BYTES):
                own = batch.slice(part.start, part.stop - part.start)
                x = made.features(lowered(own["text"]))
                yield pa.RecordBatch.from_arrays([own["toxic"], pa.array([r.tolist() for r in x], pa.list_(pa.float64()))], ["toxic", "x"])

    rows = texts.where("fold = 1").mapInArrow(measure, "toxic int, x array<double>").orderBy("toxic", "x").collect()
    y, x = np.array([r["toxic"] for r in rows], float), np.array([r["x"] for r in rows])
    if len(set(y)) < 2:
        return model
    # The classes weigh as they do among all labels.
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_toxic"))
    total = known.agg(F.count_if(F.col("_toxic") > 0).alias("t"), F.count_if(F.col("_toxic") <= 0).alias("o")).first()
    share = total["o"] / total["t"] * y.sum() / (len(y) - y.sum())
    model.weights = calibrate(x, y, np.where(y == 1, 1.0, share))
    return model


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> ToxicityModel:
    return ToxicityModel(dictionary(toxic, ordinary), dictionary(ordinary, toxic))


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """docs with a score and whether it reaches the threshold."""
    model = ToxicityModel(model.toxic, model.ordinary, model.weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, out = pc.fill_null(pc.binary_length(texts), 0).to_pylist(), []
            for part in groups(sizes, GROUP_BYTES):
                out.append(model.scores(lowered(texts.slice(part.start, part.stop - part.start))))
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.withColumn(score_col, score(F.col(text_col).cast("string"))).withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic. Same columns."""
    model = fit(docs, labels)
    # The caller's columns go along in a struct, so that none of their names can clash.
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text").alias("_text"))
    return scored(own, model, "_text", score_col="_score", predicted_col="_predicted").where("_predicted = 0").select("_row.*")


def op1_compression_toxicity(spark, sf_dir):
    """Every document's toxicity score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
