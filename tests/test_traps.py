"""Hand-computed cases of the rules that are easy to get wrong."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gleanworks.functions import scalars as sc
from gleanworks.operators import audit as au
from gleanworks.operators import curation as cu
from gleanworks.operators import evaluation as ev
from gleanworks.operators import learning as le


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def preds(spark, rows):
    return ev.with_ranks(spark.createDataFrame(rows, "id int, y int, p array<double>"))


@pytest.mark.parametrize(
    "n, w, h, said",
    [(6143, 300, 300, "too_small_bytes"), (6144, 300, 300, "ok"), (12582912, 300, 300, "ok"), (12582913, 300, 300, "too_large_bytes"), (9000, 199, 300, "small_199x300"),
     (9000, 200, 300, "ok"), (9000, 200, 800, "ok"), (9000, 200, 801, "extreme_aspect"), (9000, None, None, "decode_failed"), (10, None, None, "too_small_bytes")],
)
def test_gate_bounds(spark, n, w, h, said):
    assert one(spark, sc.gate_reason(F.lit(n), F.lit(w).cast("int"), F.lit(h).cast("int"))) == (said,)


def test_names(spark):
    f = F.lit("inat_12_34.jpg")
    assert one(spark, sc.observation_of(f), sc.photo_of(f), sc.source_of(f), sc.suffix_of(F.lit("a.JPG")), sc.observation_of(F.lit("web_1"))) == ("12", "34", "inat", ".jpg", None)
    assert one(spark, sc.leak_group(f, F.lit(3)), sc.leak_group(F.lit("web_a.jpg"), F.lit(3)), sc.leak_group(F.lit("web_a.jpg"), F.lit(None))) == ("obs12", "p3", "fweb_a.jpg")
    assert one(spark, sc.resized_url(F.lit("http://x/1/medium.jpg?square."), "large"), sc.resized_url(F.lit("http://x/1.jpg"), "large")) == ("http://x/1/large.jpg?square.", "http://x/1.jpg")


def test_half_even_sides(spark):
    assert one(spark, *sc.resized_shape(F.lit(4), F.lit(5), 2)) == (2, 2)  # 2.5 to 2
    assert one(spark, *sc.resized_shape(F.lit(4), F.lit(7), 2)) == (2, 4)  # 3.5 to 4


def test_ties_go_to_the_lower_class(spark):
    assert preds(spark, [(1, 0, [0.3, 0.3, 0.4, 0.0])]).first()["ord"] == [2, 0, 1, 3]


def test_zero_denominators(spark):
    df = preds(spark, [(1, 0, [0.9, 0.1, 0.0]), (2, 0, [0.2, 0.8, 0.0])])
    per = {r["class"]: r for r in ev.per_class(df, ev.class_dim(spark, 3)).collect()}
    assert per[2]["support"] == 0 and per[2]["recall"] == per[2]["precision"] == per[2]["f1"] == per[2]["top3_recall"] == 0.0
    assert ev.macro_and_ood(df, ev.class_dim(spark, 3), 2).first()["macro_recall"] == pytest.approx(0.5 / 3)
    curve = ev.threshold_curve(df, [0.95]).first()
    assert curve["reject_rate"] == 1.0 and math.isnan(curve["top1"])
    sweep = ev.serving_sweep(df, [0.95], 2).first()
    assert sweep["top3_on_kept"] == 0.0 and sweep["other_caught"] is None and sweep["kept_n"] == 0
    assert math.isnan(ev.topk_accuracy(df.where("id > 9")).first()["top1"])


def test_choice_of_a_threshold(spark):
    rows = [(0.2, 0.05, 0.9), (0.3, 0.10, 0.9), (0.4, 0.2, 0.99)]
    df = spark.createDataFrame(rows, "t double, fish_reject_rate double, top3_on_kept double")
    assert ev.choose_threshold(df, 0.10).first()["t"] == 0.2
    assert ev.choose_threshold(df, 0.01).first()["t"] == 0.2


def test_confusable_kinds(spark):
    def rows(y, other, n, of):
        return [(0, y, [float(c == (other if i < n else y)) for c in range(6)]) for i in range(of)]

    df = preds(spark, rows(0, 1, 6, 100) + rows(1, 0, 4, 100) + rows(2, 3, 12, 100) + rows(3, 2, 3, 100) + rows(4, 5, 4, 100) + rows(5, 4, 3, 100))
    got = {(r["a"], r["b"]): (r["kind"], r["source"]) for r in ev.confusable_pairs(df, ev.class_dim(spark, 6), [[0, 1], [2, 3], [4, 5]]).collect()}
    assert got == {(0, 1): ("symmetric", None), (2, 3): ("asymmetric", 2)}


def test_last_bucket_takes_the_rest(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(23)], "id int, s double")
    assert [r["n"] for r in au.score_buckets(df, "s", ["id"], {}).orderBy("bucket").collect()] == [2] * 9 + [5]


def test_early_stop(spark):
    df = spark.createDataFrame(list(enumerate([0.5, 0.6, 0.6, 0.55, 0.7])), "epoch int, score double")
    rows = au.early_stop(df, "epoch", "score", 2).orderBy("epoch").collect()
    assert [r["improved"] for r in rows] == [True, True, False, False, True]
    assert [r["bad"] for r in rows] == [0, 0, 1, 2, 0] and [r["stopped"] for r in rows] == [False, False, False, False, True]


def test_copies(spark):
    df = spark.createDataFrame([("a", "web_1.jpg", 9), ("a", "inat_2.jpg", 1), ("b", "web_3.jpg", 5), ("b", "web_4.jpg", 6)], "grp string, name string, area int")
    assert {r["name"] for r in cu.best_copies(df, ["grp"], F.col("area"), "name").collect()} == {"inat_2.jpg", "web_4.jpg"}
    assert {r["name"] for r in cu.first_copies(df, ["grp"], ["name"]).collect()} == {"inat_2.jpg", "web_3.jpg"}
    both = spark.createDataFrame([("k", "x", 1), ("k", "y", 2), ("m", "x", 3), ("m", "x", 4)], "key string, label string, id int")
    assert [r["id"] for r in cu.without_conflicts(both, "key", "label").orderBy("id").collect()] == [3, 4]


def test_leader_chain(spark):
    df = spark.createDataFrame([("c", 1, 0b0), ("c", 2, 0b11), ("c", 3, 0b1111)], "class string, id long, h long")
    got = {r["id"]: r["leader"] for r in cu.leader_clusters(df, 2).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("most", [0, 3, 6, 8, 11, 20, 64])
def test_hamming_pairs_match_brute_force(spark, most):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    rows = [(i, i % 3, base[i % 30] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7)))) for i in range(150)] + [(150, 0, -1 & (2**64 - 1)), (151, 1, -1 & (2**64 - 1))]
    df = spark.createDataFrame([(i, c, h - (h >> 63 << 64)) for i, c, h in rows] + [(152, 2, None), (153, None, 5)], "id long, class int, h long")
    want = [(a, b, (x ^ y).bit_count()) for a, ca, x in rows for b, cb, y in rows if a < b and ca != cb and (x ^ y).bit_count() <= most]
    assert sorted(map(tuple, cu.hamming_pairs(df, most).collect())) == want


def test_nulls_in_buckets_and_turns(spark):
    df = spark.createDataFrame([(i, float(i) if i % 3 else None) for i in range(60)], "id int, s double")
    assert sum(r["n"] for r in au.score_buckets(df, "s", ["id"], {}).collect()) == 60
    turns = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, b string")
    assert [(r["id"], r["turn"]) for r in cu.round_robin(turns, "b", ["id"]).orderBy("turn").collect()] == [(1, 1), (5, 2), (3, 3), (2, 4), (4, 5)]


def test_samples(spark):
    from gleanworks.operators import sampling as sa

    df = spark.range(100).withColumn("c", (F.col("id") < 10).cast("string"))
    assert [r["id"] for r in sa.evenly_spaced(df, "id", 5).orderBy("id").collect()] == [0, 24, 49, 74, 99]
    assert sa.evenly_spaced(df.limit(3), "id", 5).count() == 3 and sa.evenly_spaced(df.limit(0), "id", 5).count() == 0
    head = [r["id"] for r in sa.seeded_head(df, 10, 1, "id").collect()]
    assert len(set(head)) == 10 and [r["id"] for r in sa.ordered_subset(df, 10, 1, "id").collect()] == sorted(head)
    copies = {r["c"]: r["n"] for r in sa.balanced_replicates(df, "c", "id", 1).groupBy("c").agg(F.sum("copies").alias("n")).collect()}
    assert copies["true"] == 50 and 35 < copies["false"] < 65
    used = sa.replaced_rows(df, "c", "id", "id % 2 = 0 AND c = 'false'", 1).collect()
    assert len(used) == 100 and all(r["used"] is None if r["c"] == "true" else r["used"] % 2 == 0 for r in used)


def test_split_strata_and_ratios(spark):
    df = spark.createDataFrame([("c", f"f{i}", f"g{i}", "ab"[i % 2]) for i in range(40)], "class string, name string, grp string, stratum string")
    got = df.join(cu.group_split(df), ["class", "name"]).groupBy("stratum", "split").count().collect()
    assert {(r["stratum"], r["split"]): r["count"] for r in got} == {(s, k): n for s in "ab" for k, n in (("train", 14), ("val", 3), ("test", 3))}
    with pytest.raises(ValueError):
        cu.group_split(df, (0.7, 0.2, 0.2))


def test_near_stage(spark):
    df = spark.createDataFrame([("c", 1, 0b0, "web_1"), ("c", 2, 0b11, "inat_2"), ("c", 3, 0b1111, "web_3")], "class string, id long, h long, name string")
    assert {r["id"]: r["stage"] for r in cu.near_stage(df, 2, F.col("id"), "name").collect()} == {1: "near", 2: "kept", 3: "kept"}


def test_model_guard(spark, tmp_path):
    rows = [(float(i % 2), [float(i % 2), 1.0]) for i in range(20)]
    model = le.train(spark.createDataFrame(rows, "label double, v array<double>"), "v", "label", 3)
    le.save_model(model, ["a", "b"], str(tmp_path))
    assert le.load_model(spark, ["a", "b"], str(tmp_path)).stages
    with pytest.raises(ValueError):
        le.load_model(spark, ["b", "a"], str(tmp_path))
    assert le.contract_errors([None, 3, 384, 384], [None, 25], 25, 384, "other", "other") == [] and le.contract_errors([1, 1, 8], [None, 3], 25, 384, "x", "y") == ["rank", "channels", "size", "classes", "other"]


def test_group_split(spark):
    df = spark.createDataFrame([("c", f"f{i}", f"g{i}") for i in range(10)], "class string, name string, grp string")
    rows = cu.group_split(df).collect()
    n = {s: sum(r["split"] == s for r in rows) for s in ("train", "val", "test")}
    assert n == {"train": 7, "val": 2, "test": 1}
    whole = spark.createDataFrame([("c", f"f{i}", f"g{i // 4}") for i in range(40)], "class string, name string, grp string")
    assert whole.join(cu.group_split(whole), ["class", "name"]).groupBy("grp").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0


def test_append_first(spark):
    log, new = spark.createDataFrame([("a", 0)], "k string, n int"), spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "k string, n int")
    assert [tuple(r) for r in cu.append_first(log, new, ["k"], ["n"]).collect()] == [("b", 2)]
    assert sorted(tuple(r) for r in cu.append_new(log, new, ["k"]).collect()) == [("b", 2), ("b", 3)]


def test_selectors(spark):
    classes = spark.createDataFrame([(0, "cod"), (1, "eel"), (2, "other")], "idx int, name string")
    aliases = spark.createDataFrame([("all", 0), ("all", 1), ("all", 2)], "alias string, idx int")
    names = lambda df: [r["name"] for r in df.orderBy("place").collect()]
    assert names(cu.expand_selectors(["eel", "all"], classes, aliases)) == ["eel", "cod", "other"]
    assert names(cu.expand_selectors(["all"], classes, aliases, F.col("name") != "other")) == ["cod", "eel"]
    with pytest.raises(ValueError):
        cu.expand_selectors(["shark"], classes, aliases)


def test_acceptance(spark):
    assert one(spark, le.acceptance(F.lit(0.02), 0.15), le.acceptance(F.lit(0.5), 0.15)) == ((False, "low_fish_0.020"), (True, "ok"))


def test_served_json(spark):
    df = preds(spark, [(1, 0, [0.2, 0.1, 0.7])])
    text = ev.served_json(df, 0.25, 2, "v1").first()["response"]
    assert '"uncertain":true' in text and '"rank":1,"class":0,"confidence":0.2' in text and '"class":2' not in text
