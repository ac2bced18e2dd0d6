"""Rules in one pass, documents by path, and kept predictions."""

import json

from pyspark.sql import functions as F

from gleanworks.operators import cache as ca
from gleanworks.operators import constraints as co
from gleanworks.operators import documents as do
from gleanworks.plans import configuration as conf

KINDS = "idx int, name string, sci string, kind string, near array<string>"
RULES = [co.Count("rows", 3), co.Count("sea", 2, "kind = 'sea'"), co.Unique("name", "name"), co.Unique("sci", "sci"), co.Among("kind", "kind", ("sea", "other")), co.Known("near", "near", "name"), co.Last("last", "idx", "name", "other")]


def broken(spark, rows):
    found, seen = co.violations(spark.createDataFrame(rows, KINDS), RULES)
    return sorted(map(tuple, found.collect()), key=str), seen


def test_rules_that_hold_and_break(spark):
    good = [(0, "cod", "G", "sea", ["eel"]), (1, "eel", "", "sea", None), (2, "other", None, "other", [])]
    found, seen = broken(spark, good)
    assert found == [] and seen.get == {"rows": 3, "kind": 0}
    bad = [(0, "cod", "G", "sea", ["shark", "eel"]), (1, "cod", "G", "lake", ["shark"]), (2, "eel", " ", None, None), (3, "ray", " ", "sea", [None])]
    found, seen = broken(spark, bad)
    assert found == sorted([("rows", "4", 4), ("name", "cod", 2), ("sci", "G", 2), ("kind", "lake", 1), ("kind", None, 1), ("near", "shark", 2), ("near", None, 1), ("last", "ray", 1)], key=str)
    assert seen.get == {"rows": 4, "kind": 2}
    assert broken(spark, [])[0] == [("last", None, 1), ("rows", "0", 0), ("sea", "0", 0)]


def test_rules_read_the_table_once(spark, sf_dir):
    found, _ = co.violations(conf.species(spark, sf_dir), conf.RULES)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["rule"] for r in found.collect()} >= {r.rule for r in conf.RULES} - {"other_last"}


def test_documents(spark, tmp_path):
    classes = spark.createDataFrame([(1, "autre é", None, "other", "easy"), (0, "cod", "Gadus", "sea", None)], "idx int, name string, scientific string, habitat string, difficulty string")
    doc = do.label_document(classes, "autre é", 0.25, 3)
    plain = json.loads(doc.select(F.to_json("document").alias("d")).first()["d"])
    assert plain["classes"] == ["cod", "autre é"] and plain["other_index"] == 1 and plain["species"]["cod"] == {"scientific": "Gadus", "habitat": "sea"}
    assert do.missing_blocks(doc).first()["missing"] == ["img_size", "resize_shorter_to", "mean", "std"]
    full = do.with_threshold(do.stamped(doc, 384, [0.1, 0.2, 0.3], [1.0, 1.0, 1.0], "b0", "v2"), 0.4)
    do.save_documents(full, str(tmp_path / "d"))
    back = do.load_documents(spark, str(tmp_path / "d"))
    assert do.missing_blocks(back).first()["missing"] == []
    assert tuple(back.select(do.at("$.preprocess.resize_shorter_to", "int"), do.at("$.preprocess.mean[1]", "double"), do.at("$.model.version", "string"), do.at("$.confidence_threshold", "double"), do.at("$.no.such", "int")).first()) == (437, 0.2, "v2", 0.4, None)
    assert [tuple(r) for r in do.species_rows(back).orderBy("idx").collect()] == [(0, "cod", "Gadus", "sea", None), (1, "autre é", None, "other", "easy")]
    assert do.health(back).first()["code"] == 200 and json.loads(do.labels(back).first()["body"])["species"]["autre é"]["habitat"] == "other"
    assert tuple(do.labels(back.limit(0)).first()) == (503, '{"error":"MODEL_NOT_LOADED"}')
    empty = do.label_document(classes.limit(0), "x", 0.25, 3).select(do.at("$.num_classes", "int").alias("n"), do.at("$.other_index", "int").alias("o")).first()
    assert tuple(empty) == (0, None)


def test_cache(spark, tmp_path):
    df = spark.createDataFrame([(1, b"a"), (2, b"a"), (3, b"bb"), (4, None), (5, b"")], "id int, content binary")
    calls = []

    def score(missing):
        calls.append(sorted(bytes(r["content"]) for r in missing.collect()))
        return missing.withColumn("p", F.array(F.octet_length("content").cast("double")))

    run = lambda rows, model="m", pre="x": ca.cached_scores(rows, "content", model, pre, score, str(tmp_path / "store"))
    found, scored = run(df)
    assert {r["id"]: r["p"] for r in found.collect()} == {1: [1.0], 2: [1.0], 3: [2.0], 4: None, 5: [0.0]} and scored == 3
    assert run(df)[1] == 0 and run(df.where("id < 3"))[1] == 0
    changed = df.withColumn("content", F.when(F.col("id") == 3, F.lit("bc").cast("binary")).otherwise(F.col("content")))
    assert run(changed)[1] == 1 and run(df, model="m2")[1] == 3 and run(df, pre="y")[1] == 3
    assert calls == [[b"", b"a", b"bb"], [], [], [b"bc"], [b"", b"a", b"bb"], [b"", b"a", b"bb"]]
    # The ends of the key's parts can't be moved into one another.
    keys = spark.range(1).select(ca.fingerprint(F.lit("c"), "ab", "x"), ca.fingerprint(F.lit("c"), "a", "bx"), ca.fingerprint(F.lit("xc"), "ab", "")).first()
    assert len(set(keys)) == 3


def test_rules_over_dealt_rows(spark, sf_dir, monkeypatch):
    """Rows are dealt to tasks by their number before they become facts, so one file is not one task's facts."""
    few = sorted(map(tuple, co.violations(conf.species(spark, sf_dir), conf.RULES)[0].collect()), key=str)
    monkeypatch.setattr(co, "ROWS", 30)
    df = conf.species(spark, sf_dir)
    found, seen = co.violations(df, conf.RULES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and f", {-(-df.count() // 30)}" in plan
    assert sorted(map(tuple, found.collect()), key=str) == few and seen.get["rows"] == df.count()
