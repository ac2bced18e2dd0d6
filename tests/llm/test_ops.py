import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from gleanworks.llm import common, components, flac, knn, lm_score, media, mixing, ngram_join, packing, sharding, shingles, token_counts, tokens, toxicity, url_filter
from gleanworks.session import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "a b c d e f g. " * 20_000


def cases(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and a column whose name clashes."""
    rows = [(1, "one two three four five six", "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0), (4, LONG, "en", "t", 1), (None, "null id here", "en", None, 2),
            (5, "tie tie", "en", "t", 1), (6, "tie tie", "en", "t", 1), (6, "tie tie", "en", "t", 1), (7, " \t\n ", "fr", "", 1), (8, "one two three four five six", "en", "é", 9)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("size", "rank", "score", "length", "offset", "entity")})


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# ranks and components


def test_ranked(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.col("id"))
    hot = [{"k": 0, "n": 2000}]
    monkeypatch.setattr(common, "HOT_ROWS", 300)
    assert common.ranked(df, ["k"], ["id"], [], 3000).orderBy("k", "id").first()["rank"] == 0
    rows = common.ranked(df, ["k"], ["id"], hot, 3000).collect()
    by = Counter(r["k"] for r in rows)
    assert sorted((r["k"], r["rank"]) for r in rows) == sorted((k, i) for k, n in by.items() for i in range(n))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    ids = {n: rng.getrandbits(62) for e in edges for n in e}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame([(ids[a], ids[b]) for a, b in edges], "u long, v long")).collect()}
    for a, b in edges:
        assert a == b or got[ids[a]] == got[ids[b]]
    assert len({got[ids[i]] for i in range(51)} | {got[ids[100]]}) == 2


# 1 toxicity


def toxic_table(spark, n=600):
    rng, words = random.Random(1), [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("an", "or", "el", "un") for c in ("ta", "mi", "so", "re")]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(60)]
        toxic = rng.random() < 0.3
        for _ in range(4 if toxic else 0):
            text.insert(rng.randrange(60), rng.choice(["grumzig", "vilporth", "skadnash"]))
        rows.append((i, " ".join(text), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_held_out_rows(spark):
    df = toxic_table(spark)
    model = toxicity.fit(df, df)
    rows = toxicity.scored(df.withColumn("held", toxicity.held_out("doc_id")), model).where("held").collect()
    assert 100 < len(rows) < 200
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.95
    assert all(bool(r["held"]) == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_toxicity_learns_nothing_from_the_held_out_fold(spark):
    df = toxic_table(spark, 300)
    flipped = df.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(df, df), toxicity.fit(flipped, flipped)
    assert a.toxic == b.toxic and np.array_equal(a.weights, b.weights)


def test_toxicity_cases(spark):
    df = toxic_table(spark, 300)
    model = toxicity.fit(df, df)
    rows = toxicity.scored(cases(spark), model).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(empty(spark), model).count() == 0
    blind = toxicity.fit(df, df.where("toxic = 0"))
    assert {r["score"] for r in toxicity.scored(df, blind).collect()} == {toxicity.BLIND}
    named = cases(spark).withColumns({c: F.lit("mine") for c in ("score", "predicted", "_row", "_text", "_score", "_id", "toxic", "fold")})
    kept = toxicity.without_toxic(named, df.select("doc_id", "toxic"))
    assert kept.columns == named.columns and {(r["score"], r["predicted"], r["_score"]) for r in kept.collect()} == {("mine", "mine", "mine")}


def test_toxicity_scores_recomputed_plainly(spark):
    import zstandard as zs

    df = toxic_table(spark, 300)
    model = toxicity.fit(df, df)
    assert model.toxic != model.ordinary and b"grumzi" in model.toxic
    size = max(len(model.toxic), len(model.ordinary))
    params = zs.ZstdCompressionParameters.from_level(3, min_match=5, strategy=zs.STRATEGY_DFAST, window_log=17, hash_log=15, chain_log=15, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)

    def length(own, window):
        d = zs.ZstdCompressionDict((b"\n" * size + own)[-size:] * (size > 0) + toxicity.ANCHOR, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        return len(zs.ZstdCompressor(dict_data=d, compression_params=params).compress(toxicity.ANCHOR + b" " + window + b" "))

    def score(text):
        w, gaps, i = (text or "").lower().encode().split(), [], 0
        while True:
            part = b" ".join(w[i : i + 4])
            gaps.append(length(model.ordinary, part) - length(model.toxic, part))
            i += 2
            if i > max(0, len(w) - 3):
                break
        h, less = [sum(g >= x for g in gaps) for x in range(1, 13)], [sum(g <= -x for g in gaps) for x in (1, 2, 3, 5)]
        x = [math.log(1 + n) for n in h] + [math.log(1 + n) for n in less] + [min(n, 6) / 2 for n in h] + [math.log(len(gaps))]
        return 1 / (1 + math.exp(-(model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], x)))))

    rows = toxicity.scored(df.where("doc_id % 12 = 0").unionByName(cases(spark).select("doc_id", "text").where("doc_id IS NULL OR doc_id <> 4").withColumn("toxic", F.lit(0))), model).collect()
    assert len(rows) > 30 and all(abs(r["score"] - score(r["text"])) < 1e-9 for r in rows)


def test_toxicity_windows_depend_on_the_order_of_words(spark):
    df = toxic_table(spark, 300)
    model, rng = toxicity.fit(df, df), random.Random(5)
    texts = [r["text"] for r in df.where("toxic = 1").collect()]
    changed = 0
    for text in texts:
        words = text.split()
        rng.shuffle(words)
        a, b = model.features([text.encode(), " ".join(words).encode()])
        changed += not np.array_equal(a, b)
    assert changed > len(texts) / 2
    assert [toxicity.windows(b"a b c d e f g"), toxicity.windows(b""), toxicity.windows(b"x" * 40)] == [[b"a b c d", b"c d e f", b"e f g"], [b""], [b"x" * 32 + b" " + b"x" * 8]]


# 2 packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    counts, used = Counter(lengths), {}
    for run in packing.plan(counts, 64):
        for r in range(run["first"], run["last"]):
            q, i = divmod(r - run["first"], run["each"])
            used.setdefault(run["sequence"] + q, []).append((run["at"] + i * run["length"], run["length"]))
    for own in used.values():
        ends = 0
        for at, n in sorted(own):
            assert at == ends
            ends += n
        assert ends <= 64
    assert Counter(n for own in used.values() for _, n in own) == counts
    assert len(used) == brute.best_fit_decreasing(lengths, 64)


def test_pieces_match_the_tokenizer(spark, docs):
    whole = tokens.encoder(packing.tokenizer_path()).whole
    got = packing.sequences(packing.pack(packing.token_pieces(docs, packing.tokenizer_path(), ids=True))).collect()
    assert all(len(r["ids"]) == 4 * r["n_ids"] <= 8192 for r in got)
    rows = packing.pack(packing.token_pieces(docs, packing.tokenizer_path(), ids=True)).orderBy("doc_id", "piece").collect()
    parts = {}
    for r in rows:
        assert r["start"] == len(parts.get(r["doc_id"], b"")) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        parts[r["doc_id"]] = parts.get(r["doc_id"], b"") + r["ids"]
    assert parts == {r["doc_id"]: whole(r["text"] or "") + b"\0\0\0\0" for r in docs.collect()}


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aB1é ',.\n\tß'sΣİ\x1c<|endoftext|>  "), st.characters(codec="utf-8")), max_size=60))
def test_cached_tokens_are_the_tokenizers(text):
    e = tokens.encoder(packing.tokenizer_path())
    assert e.encode([text]) == [e.whole(text)]


def test_packing_cases(spark):
    rows = packing.packed_documents(cases(spark)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) == 10 + sum(r["piece"] > 0 for r in rows)
    assert packing.packed_documents(empty(spark)).count() == 0


# 3 n-gram join


def copies(seed, n=260):
    rng, words = random.Random(seed), [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(70)]
    rows = []
    for g in range(n // 10):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 40, 120]))] + (passage if g % 3 == 0 else [])
        for _ in range(10):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own).upper() if rng.random() < 0.2 else "\t".join(own)))
    rows += [(len(rows) + i, " ".join(passage + [f"x{i}"] * (i % 3))) for i in range(40)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_match_all_pairs(spark, seed):
    rows = copies(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_groups(rows)


def test_near_groups_with_cut_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 700)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 5_000)
    rows = copies(4, 120)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_groups(rows)


@pytest.mark.parametrize("sample, held", [(4000, 2), (40, 2), (30, 1)])
def test_near_groups_with_common_shingles(spark, monkeypatch, sample, held):
    monkeypatch.setattr(ngram_join, "SAMPLE", sample)
    monkeypatch.setattr(ngram_join, "HELD", held)
    rows = copies(5, 160)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_groups(rows)


@pytest.mark.parametrize("kept", [0, 7, 1_000_000])
def test_near_groups_in_small_batches_with_copies(spark, monkeypatch, kept):
    monkeypatch.setattr(ngram_join, "FLUSH", 300)
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 200)
    monkeypatch.setattr(ngram_join, "COPIES", kept)
    rows = copies(6, 120)
    rows += [(1000 + i, rows[i % 40][1]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(docs).collect()}
    assert got == brute.near_groups(rows)


def shuffled(spark, df):
    """Bytes that a run of df shuffles."""
    sc = spark.sparkContext
    stages = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    seen = lambda: {(x := s.apply(i)).stageId(): x.shuffleWriteBytes() for s in [stages()] for i in range(s.size())}
    before = set(seen())
    df.write.format("noop").mode("overwrite").save()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(v for k, v in seen().items() if k not in before)


def test_a_dealt_shingle_takes_as_many_bytes_in_many_buckets(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)),) for _ in range(600)]
    docs = spark.createDataFrame(rows, "text string").coalesce(1)
    took = []
    for size in (4_000_000, 4_000):
        monkeypatch.setattr(ngram_join, "BUCKET_BYTES", size)
        took.append(shuffled(spark, ngram_join.shared_sets(docs)) / (600 * 296))
    assert max(took) < 8, took


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**31), st.integers(0, 2**64 - 1)), min_size=1, max_size=60))
def test_batched_rows_are_read_back(rows):
    key, number, h = (np.array(x, kind) for x, kind in zip(zip(*sorted(rows)), (np.int64, np.int64, np.uint64)))
    made = list(ngram_join._batched(key, number, h))
    row, numbers, low = ngram_join._gathered(ngram_join._rows([(k, 0, gaps, data, None) for _, _, k, gaps, data in made]))
    assert [made[i][2] for i in row] == key.tolist() and numbers.tolist() == number.tolist() and np.array_equal(low, h & ngram_join.LOW)


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.integers(0, 40))
def test_folded_bitmaps_are_those_of_the_band_below(s, band):
    h = np.array(sorted(s), np.uint64)
    own, above = (np.frombuffer(ngram_join.bitmap(h, b), np.uint8)[None] for b in (band, band + 1))
    assert np.array_equal(ngram_join.folded(above, own.shape[1]), own)


def test_common_shingles_are_those_of_a_share(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(20)) + " " + passage * (i % 3 == 0)) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    h, held = ngram_join.common_shingles(docs, ngram_join.memberships(docs))
    want = shingles.shingle_sets([passage.encode()])[0]
    assert set(h.tolist()) == set(want.tolist()) and np.all(abs(held.astype(int) - 3000) < 600)


def test_buckets_of_a_passage_in_a_third_of_all_texts():
    rng = np.random.default_rng(7)
    passage, buckets = rng.integers(0, 1 << 63, 65, dtype=np.uint64) * np.uint64(2), 64
    sets = [np.concatenate([rng.integers(0, 1 << 63, 65, dtype=np.uint64), passage if i % 3 == 0 else passage[:0]]) for i in range(6000)]
    h, entity = np.concatenate(sets), np.repeat(rng.integers(-(1 << 63), (1 << 63) - 1, 6000), [len(s) for s in sets])
    common = passage[np.argsort(passage & ngram_join.LOW)]
    for named, most in ((common[:0], None), (common, 2)):
        bucket = ngram_join.bucket_of(h, entity, named, buckets)
        sizes = np.bincount(bucket, minlength=buckets)
        assert most is None or sizes.max() < most * np.median(sizes)
        for b in (0, 7):
            own = bucket == b
            names, place = ngram_join.named_hashes(h[own] & ngram_join.LOW, entity[own], named, b, buckets)
            hot = np.isin(h[own], named)
            assert np.array_equal(place >= 0, hot) and np.array_equal(names[hot], h[own][hot])


def test_stars_by_broadcast_and_by_join(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, rng.randrange(50), [rng.choice([1, 2, rng.randrange(100, 400)]) for _ in range(3)]) for i in range(600)]
    sets = spark.createDataFrame(rows, "entity long, weight long, firsts array<long>")
    want = set()
    for seed in range(3):
        for first in {r[2][seed] for r in rows}:
            own = [(r[1], r[0]) for r in rows if r[2][seed] == first]
            want |= {(max(own)[1], e) for _, e in own if e != max(own)[1]}
    for heads in (1, 20, 1000):
        monkeypatch.setattr(ngram_join, "HOT_HEADS", heads)
        assert {(r["u"], r["v"]) for r in ngram_join.stars(sets).collect()} == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB \t\n\x1c\xa0é"), max_size=40), min_size=1, max_size=4))
def test_set_sizes(texts):
    got = shingles.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in got] == [len(brute.shingles(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.sets(st.integers(0, 2**63), min_size=1, max_size=60))
def test_bitmaps_bound_the_overlap(a, b):
    a |= set(list(b)[: len(b) // 2])
    band = int(np.searchsorted(ngram_join.EDGES, max(len(a), len(b)), side="right")) - 1
    m = [np.frombuffer(ngram_join.bitmap(np.array(sorted(s), np.uint64), band), np.uint64) for s in (a, b)]
    assert (len(a) + len(b) - int(np.bitwise_count(m[0] ^ m[1]).sum())) // 2 >= len(a & b)


def test_bands_hold_linked_sizes():
    for n in range(1, 3000):
        band = np.searchsorted(ngram_join.EDGES, [n, -(-n * 3 // 4)], side="right")
        assert band[0] - band[1] <= 1


def test_near_cases(spark):
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in ngram_join.near_groups(cases(spark)).collect()))
    assert [g for g in got if g[0] in (1, 8, 5, 6, 2, 3, 7)] == [(1, 2, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (6, 1, 5), (6, 1, 5), (7, 0, 7), (8, 2, 1)]
    assert ngram_join.near_groups(empty(spark)).count() == 0
    kept = ngram_join.one_of_each(cases(spark))
    assert kept.columns == cases(spark).columns and sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 7]


def test_one_of_each_by_id_and_text(spark):
    a, b, c = ("one two three four five six seven", "other words are in this text here", "a third text of seven words again")
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (3, b, "y"), (3, b, "y"), (3, b, "z"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (4, None, "x"), (4, None, "x"), (None, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _mark string").withColumns({x: F.lit("mine") for x in ("_row", "_nth", "_blank", "group", "text_hash", "entity", "a.b")})
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns and {r["_row"] for r in kept.collect()} == {"mine"}
    key = lambda r: (r[0] or 0, r[1] or "", r[2])
    assert sorted(map(key, kept.collect())) == sorted(map(key, [(1, a, "x"), (1, b, "x"), (None, c, "x"), (4, None, "x"), (4, None, "x"), (None, "", "x")]))


# 4 url filter


def test_urls(spark):
    rows = [("http://A.com", "a.com", "", None, "allow"), ("x://B.Com/", "b.com", "/", "com/", "allow"), ("https://www.example.com/en/x?porn", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
            ("https://x.example.com/en/#a", "x.example.com", "/en/", "example.com/en/", "block"), ("http://notexample.org/EN/porn", "notexample.org", "/EN/porn", None, "block"),
            ("http://a.org/porntal", "a.org", "/porntal", None, "allow"), ("http://a.org/casino-poker", "a.org", "/casino-poker", None, "block"), ("http://a.org/casino-casino", "a.org", "/casino-casino", None, "allow"),
            ("http://xxx.org", "xxx.org", "", None, "block"), ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("http://a.org?x/y", "a.org", "", None, "allow"), ("http://a.org/out?to=pornhub", "a.org", "/out", None, "block"), ("http://a.org/#casino-gratis", "a.org", "/", None, "block"), ("pornhub.org/x", "", "", None, "block"), ("http://a.net/fr/", "a.net", "/fr/", "net/fr/", "block"),
            ("http://a.org/" + "p" * 100_000 + "/xxx", "a.org", "/" + "p" * 100_000 + "/xxx", None, "block")]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id int, url string")
    got = url_filter.judge(df).orderBy("page_id").collect()
    assert [(r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == rows
    assert url_filter.judge(df.where("page_id < 0")).count() == 0


def test_terms_block_urls_without_a_rule(spark):
    blocked = ["http://a.org/roulette-bonus", "http://lotto-prizes.org/", "http://bookmakers.a.org/wagers", "http://a.org/xanax/discount", "http://sildenafil.org", "http://a.org/popups-ads", "http://strippers.org/naked"]
    allowed = ["http://a.org/adult-education", "http://a.org/free/software", "http://a.org/track/7", "http://a.org/pharmacy", "http://a.org/alphabets", "http://winners.a.org/"]
    df = spark.createDataFrame([(u,) for u in blocked + allowed], "url string")
    got = {r["url"]: (r["rule"], r["verdict"]) for r in url_filter.judge(df).collect()}
    assert got == {u: (None, "block") for u in blocked} | {u: (None, "allow") for u in allowed}


def test_url_columns_and_a_page_table(spark, tmp_path):
    rows = [(1, "http://a.org/wetten/gratis", None), (2, "http://a.org/apuestas-casino", None), (3, "http://a.org/viagra", None), (4, "http://a.org/pilules", None), (5, "http://news.org/sport", None), (6, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.op4_url_terms(spark, str(tmp_path)).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow")}
    mine = spark.createDataFrame([("http://a.org", "x", "y")], "url string, host string, other string")
    assert tuple(url_filter.judge(mine).select("host", "other", "verdict").first()) == ("a.org", "y", "allow")


# 5 language models


def test_lm_scores_match_plain_counts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    target, size = texts[:15], 10
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score_texts(df, df.where("doc_id < 15"), df, size).collect()}
    hashes = {w: int(shingles.word_hashes([w.encode()])[0].view(np.int64)[0]) for t in texts for w in t.split()}
    n = Counter(w for t in target + texts for w in t.split())
    known = {w for w, _ in sorted(n.items(), key=lambda x: (-x[1], hashes[x[0]]))[: size - 2]}

    def model(corpus):
        pairs = Counter((a, b) for t in corpus for a, b in zip(["<s>", *(w if w in known else "?" for w in t.split())], [w if w in known else "?" for w in t.split()]))
        word, context = Counter(), Counter()
        for (a, b), c in pairs.items():
            word[b] += c
            context[a] += c
        total = sum(word.values())
        own = lambda b: (word[b] + 1) / (total + size)
        return lambda a, b: -math.log(0.7 * pairs[a, b] / context[a] + 0.3 * own(b) if context[a] else own(b))

    one, two = model(target), model(texts)
    for i, t in enumerate(texts):
        w = [x if x in known else "?" for x in t.split()]
        if not w:
            assert got[i]["score"] is None
            continue
        want = sum(one(a, b) - two(a, b) for a, b in zip(["<s>", *w], w)) / len(w)
        assert got[i]["score"] == pytest.approx(want, abs=1e-4) and got[i]["n_words"] == len(w)


def plain_lm_scores(texts, target, background):
    """{position: (target loss, background loss)} by plain counts over the whole vocabulary."""
    size = len({w for t in target + background for w in t.split()}) + 2

    def model(corpus):
        pairs = Counter(p for t in corpus for p in zip(["<s>", *t.split()], t.split()))
        word, context = Counter(), Counter()
        for (a, b), c in pairs.items():
            word[b] += c
            context[a] += c
        own = lambda b: (word[b] + 1) / (sum(word.values()) + size)
        return lambda a, b: -math.log(0.7 * pairs[a, b] / context[a] + 0.3 * own(b) if context[a] else own(b))

    models = model(target), model(background)
    return {i: [sum(m(a, b) for a, b in zip(["<s>", *t.split()], t.split())) / len(t.split()) for m in models] for i, t in enumerate(texts) if t.split()}


@pytest.mark.parametrize("hot", [10**9, 30])
@pytest.mark.parametrize("apart", [False, True])
def test_lm_tells_all_words_apart(spark, monkeypatch, hot, apart):
    monkeypatch.setattr(lm_score, "HOT", hot)
    rng = random.Random(5)
    texts = [" ".join(["the", "of"][rng.randrange(2)] if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(rng.randrange(0, 120))) for _ in range(120)]
    assert len({w for t in texts for w in t.split()}) > 1024
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    background = df.where("doc_id >= 60") if apart else df
    want = plain_lm_scores(texts, texts[:15], texts[60:] if apart else texts)
    rows = lm_score.score_texts(df.repartition(3), df.where("doc_id < 15"), background).collect() if apart else lm_score.score_texts(df, df.where("doc_id < 15"), df).collect()
    got = {r["doc_id"]: [r["target_loss"], r["background_loss"]] for r in rows if r["n_words"]}
    assert len(rows) == len(texts) and got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], abs=1e-6)


def test_lm_cases(spark):
    got = lm_score.score_texts(cases(spark), cases(spark).where("doc_id = 1"), cases(spark))
    assert got.count() == 10 and got.where("score IS NULL").count() == 3
    assert lm_score.score_texts(empty(spark), empty(spark), empty(spark)).count() == 0


# 6 nearest vectors


@pytest.mark.parametrize("clustered", [False, True])
def test_knn_matches_all_products(spark, clustered):
    rng = np.random.default_rng(7)
    x = rng.integers(-3, 4, (400, 6)) + (clustered * 40 * np.eye(6, dtype=int)[rng.integers(0, 6, 400)])
    x[50:120] = x[50]  # a common vector
    df = spark.createDataFrame([(i, [int(c) for c in v]) for i, v in enumerate(x)], "id long, vec array<long>")
    got = {}
    for r in knn.nearest_join(df, df.where("id % 20 = 0"), 20).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in range(0, 400, 20):
        s = x @ x[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-s[i], i))[:20]
        assert got[q] == {k + 1: (i, int(s[i])) for k, i in enumerate(order)}


def test_knn_cell_plan_prunes_only_what_cannot_matter():
    rng = np.random.default_rng(3)
    p = rng.integers(-50, 50, (8, 4)) * 20
    x = np.repeat(p, 30, 0) + rng.integers(-2, 3, (240, 4))
    cell = ((x[:, None] - p) ** 2).sum(2).argmin(1)
    far = np.sqrt(((x - p[cell]) ** 2).sum(1))
    cells = [{"cell": c, "n": int((cell == c).sum()), "radius": float(far[cell == c].max())} for c in np.unique(cell)]
    plan = set(knn.cell_plan(cells, cells, p, 5))
    assert len(plan) < len(cells) ** 2
    for q in range(240):
        best = np.argsort(-(x @ x[q]), kind="stable")[:6]
        assert all((cell[b], cell[q]) in plan for b in best if (x[b] @ x[q]) > np.sort(x @ x[q])[-6])


def test_knn_with_small_shares(spark, monkeypatch):
    for name, n in (("BLOCK_BYTES", 500), ("CHUNK_BYTES", 1500), ("GROUP_BYTES", 800), ("ROWS", 5)):
        monkeypatch.setattr(knn, name, n)
    test_knn_matches_all_products(spark, True)


def test_knn_repeated_ids_lengths_and_names(spark):
    rows = [(20, [1, 2, 3]), (20, [1, 2]), (1, [5]), (1, [0, 0, 9]), (2, [4, 4, 4]), (2, [4, 4, 4])]
    df = spark.createDataFrame(rows, "id long, vec array<long>").withColumns({c: F.lit("mine") for c in ("vid", "cell", "part", "n", "score", "rank")})
    got = [(r["rank"], r["vec_id"], r["score"]) for r in knn.nearest_join(df, df.where("id = 20"), 3).collect()]
    assert sorted(got) == sorted([(1, 1, 27), (2, 2, 24), (3, 2, 24), (1, 2, 12), (2, 2, 12), (3, 1, 5)])


def test_best_of():
    rng = np.random.default_rng(1)
    scores, names = rng.integers(0, 5, (7, 40)), np.broadcast_to(rng.permutation(40), (7, 40))
    row, at = knn.best_of(scores, names, 6)
    score, name = scores[row, at], names[row, at]
    want = [(i, s, n) for i in range(7) for s, n in sorted(zip(scores[i].tolist(), names[i].tolist()), key=lambda x: (-x[0], x[1]))[:6]]
    assert list(zip(row.tolist(), score.tolist(), name.tolist())) == want


def test_knn_cases(spark):
    rows = [(0, [0.5, None]), (20, None), (40, [float("nan"), 1.0]), (60, [float("inf"), 1.0]), (80, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = knn.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    got = knn.nearest_join(df, df.where("id % 20 = 0"))
    assert sorted(map(tuple, got.collect())) == [(80, 1, 1, 2048), (80, 2, 2, 2048)]
    none = df.where("id < -5")
    assert knn.nearest_join(none, none).count() == 0


# 7 token counts


def test_section_counts(spark, docs):
    encode, size = token_counts.encoding(token_counts.ranks_path())
    for rule in token_counts.RULES:
        got = token_counts.section_tokens(docs, token_counts.ranks_path(), rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("stop").alias("stop")).collect()
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        assert {r["doc_id"]: (r["n"], r["stop"]) for r in got} == {d: (len(encode(t)), len(t)) for d, t in texts.items()}


def test_crossing_tokens():
    starts = np.array([0, 3, 4])
    first, last = np.array([0, 2, 2, 5]), np.array([1, 3, 6, 6])
    assert token_counts.allocate(first, last, starts, "first").tolist() == [3, 0, 1]
    assert token_counts.allocate(first, last, starts, "last").tolist() == [1, 1, 2]
    assert token_counts.allocate(first, last, starts, "most").tolist() == [2, 0, 2]


def test_token_cases(spark):
    got = token_counts.section_tokens(cases(spark), token_counts.ranks_path())
    assert [tuple(r) for r in got.where("doc_id IN (2, 3)").orderBy("doc_id").collect()] == [(2, 0, 0, 0, 0), (3, 0, 0, 0, 0)]
    assert token_counts.section_tokens(empty(spark), token_counts.ranks_path()).count() == 0


# 8 sharding


def test_shards(spark, sf_dir):
    rows = sharding.op8_ring_shards(spark, sf_dir).collect()
    by = Counter(r["shard"] for r in rows)
    assert set(by) == set(range(8)) and max(by.values()) - min(by.values()) <= 1
    for s in by:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(by[s]))


def test_ring_moves_little():
    counts = {s: 10 for s in range(sharding.RING_SLOTS)}

    def owners(n):
        out = {}
        for r in sharding.walk_plan(counts, n):
            for k in range(r["first"], r["last"]):
                out[r["ring_slot"], k] = r["shard"]
        return out

    a, b = owners(8), owners(9)
    assert len(a) == len(b) == 10 * sharding.RING_SLOTS
    assert sum(a[k] != b[k] for k in a) / len(a) < 0.4


def test_shard_cases(spark):
    df = cases(spark).select("doc_id", F.crc32(F.encode(common.text_or_empty(), "UTF-8")).alias("text_crc32"), F.lit(1).alias("size"))
    rows = sharding.shard_rows(df, "doc_id", ["doc_id", "text_crc32"], 8).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [1] * 6 + [2] * 2
    assert sharding.shard_rows(df.where("doc_id < 0"), "doc_id", ["doc_id"], 8).count() == 0


# 9 mixing


def test_mix(spark, docs):
    rows = mixing.mix(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(brute.WORD.findall(r["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
    want, taken = brute.targets(sizes), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
    most = {s: max(r["size"] for r in rows if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= max(0.02 * want[s], most[s]) for s in sizes)
    again = mixing.mix(docs.repartition(7)).select("doc_id", "taken")
    assert {r["doc_id"]: r["taken"] for r in again.collect()} == {r["doc_id"]: r["taken"] for r in rows}


def test_full_sources_stop_at_three_times(spark):
    df = spark.createDataFrame([(i, "w " * 50, "a") for i in range(4)] + [(10 + i, "w " * 50, "b") for i in range(60)], "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    assert {r["copies"] for r in rows if r["doc_id"] < 10} == {3}
    assert sum(r["taken"] for r in rows) == pytest.approx(64 * 50, abs=50)


def test_mixed_documents(spark, docs):
    out = mixing.mixed_documents(docs)
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect()) == want


@pytest.mark.parametrize("hot_rows", [20_000, 50])
def test_mixed_documents_with_many_equal_rows(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    rows = [(None, "a b c", "s")] * 300 + [(i, "word " * (i % 7 + 1), "st"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, got = Counter(), Counter(r["doc_id"] for r in mixing.mixed_documents(df).collect())
    for r in mixing.mix(df).collect():
        want[r["doc_id"]] += r["copies"]
    assert got == +want and 0 < got[None] != 300


def test_mix_cases(spark):
    rows = mixing.mix(cases(spark)).collect()
    assert len(rows) == 10 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(empty(spark)).count() == 0
    assert set(mixing.mixed_documents(cases(spark)).columns) == set(cases(spark).columns)


# 10 FLAC


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=2000), min_size=1, max_size=4), st.sampled_from([0, 1, 2, 6]))
def test_flac_round_trip(data, order):
    payloads = [media.padded(d) for d in data]
    assert flac.decode_streams(flac.encode_streams(payloads, order)) == payloads


def test_flac_uses_each_subframe():
    t = np.arange(576 * 4)
    waves = [np.full(576, 9), np.random.default_rng(1).integers(0, 256, 576), (t // 5) % 256, 128 + 100 * np.sin(t / 3), 128 + 60 * np.sin(t / 9)]
    payloads = [np.asarray(w).astype(np.uint8).tobytes() for w in waves]
    streams = flac.encode_streams(payloads, 2)
    kinds = set()
    for m in streams:
        _, points, at, _ = flac.read_header(m)
        kinds |= {m[at + p + 6] >> 1 for p in points.tolist()}
    assert {0, 1} <= kinds and any(8 <= k <= 12 for k in kinds) and any(k >= 32 for k in kinds)
    assert flac.decode_streams(streams) == payloads


def test_flac_damage_is_found():
    stream = flac.encode_streams([media.padded(b"some text " * 200)])[0]
    _, points, at, _ = flac.read_header(stream)
    for spot in (20, at + 3, at + 5, at + 60, len(stream) - 1, int(points[1]) + at + 30):
        bad = bytearray(stream)
        bad[spot] ^= 0x10
        with pytest.raises(flac.FlacError):
            flac.decode_streams([bytes(bad)])


def test_crc_known_values():
    data = np.frombuffer(b"123456789", np.uint8)
    at, n = np.array([0]), np.array([9])
    assert flac.crcs(data, at, n, 8, 0x07)[0] == 0xF4 and flac.crcs(data, at, n, 16, 0x8005)[0] == 0xFEE8


def test_media_cases(spark):
    encoded = media.encode_media(cases(spark))
    rows = {r["doc_id"]: r for r in media.media_digest(encoded).collect()}
    assert rows[2]["payload_sha256"] == rows[3]["payload_sha256"] and rows[2]["payload_bytes"] == 576 and rows[2]["n_bytes"] == 0
    assert rows[5]["media_sha256"] == rows[6]["media_sha256"]
    blocks = media.pcm_blocks(encoded, 4).where("id = 4").orderBy("sample_offset").collect()
    pcm = np.frombuffer(b"".join(r["pcm"] for r in blocks), np.uint8) ^ 0x80
    assert pcm.tobytes() == media.padded(LONG.encode()) and [r["sample_offset"] for r in blocks] == [i * 4 * 576 for i in range(len(blocks))]
    assert media.media_digest(media.encode_media(empty(spark))).count() == 0
    found = media.samples_at(encoded.where("id = 4").withColumn("at", F.lit(576 * 7 + 5)), "at").first()
    assert found["block_offset"] == 576 * 7 and found["pcm"] == pcm[576 * 7 : 576 * 8].tobytes().translate(bytes(b ^ 0x80 for b in range(256)))


def test_shard_columns_of_the_caller(spark):
    df = spark.range(50).withColumns({c: F.lit("mine") for c in ("rank", "first", "last", "base", "_own", "_piece", "_row", "_by0", "a.b")})
    got = sharding.shard_rows(df, "id", ["id"], 3)
    assert got.columns == [*df.columns, "ring_slot", "shard", "slot"] and {(r["rank"], r["_own"], r["a.b"]) for r in got.collect()} == {("mine",) * 3}
