import json
import os
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from gleanworks.operators import collection as co
from gleanworks.sources import files, images


def png(h, w, value=0):
    row = lambda i: b"\0" + bytes((value + i + j + c) % 256 for j in range(w) for c in range(3))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(map(row, range(h))))) + chunk(b"IEND", b"")


def test_side_tables(spark, tmp_path):
    (tmp_path / "dup.csv").write_text("﻿species,group,filename\ncod,1,a.jpg\n", encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "dup.csv"), files.DUP_GROUPS).collect() == [("cod", 1, "a.jpg")]
    (tmp_path / "rejected.txt").write_text("# note\n\n cod/a.jpg \ncod/b/c.jpg\nnothing\ncod/a.jpg\n")
    assert sorted(map(tuple, files.rejected_list(spark, str(tmp_path / "rejected.txt")).collect())) == [("cod", "a.jpg"), ("cod", "b/c.jpg")]


def test_images(spark, tmp_path):
    for name, data in {"cod/a.PNG": png(210, 220), "cod/b.txt": b"x", "eel/c.jpg": b"junk"}.items():
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    found = files.image_files(spark, str(tmp_path))
    assert sorted((r["class"], r["filename"]) for r in found.collect()) == [("cod", "a.PNG"), ("eel", "c.jpg")]
    read = images.read_images(spark, str(tmp_path / "cod")).where("height > 0")
    assert read.select(images.phash("data", "height", "width", "channels").isNotNull()).first()[0]
    content = files.image_files(spark, str(tmp_path), with_content=True).select("filename", images.serving_error(F.col("content"), F.lit(9), F.lit(9)).alias("e"))
    assert {r["filename"]: r["e"] for r in content.collect()} == {"a.PNG": None, "c.jpg": "IMAGE_DECODE_FAILED"}


def test_serving_errors(spark):
    cases = [(b"", 9, 9, "EMPTY_FILE"), (b"II*\0", 9, 9, "UNSUPPORTED_FORMAT"), (b"\xff\xd8\xff", 9000, 9000, "IMAGE_TOO_LARGE"), (b"\xff\xd8\xff", 1, 9, "IMAGE_DECODE_FAILED"), (b"\xff\xd8\xff", 9, 9, None)]
    df = spark.createDataFrame([(i, bytearray(c), w, h) for i, (c, w, h, _) in enumerate(cases)], "i int, c binary, w int, h int")
    rows = df.select("i", images.serving_error(F.col("c"), F.col("w"), F.col("h")).alias("e")).withColumn("s", images.status_of(F.col("e"))).orderBy("i").collect()
    assert [r["e"] for r in rows] == [c[3] for c in cases] and [r["s"] for r in rows] == [400, 415, 413, 400, 200]


def test_picture_arithmetic():
    x = np.random.default_rng(1).integers(0, 256, (240, 300, 3)).astype(np.uint8)
    assert images.model_input(x, 32, 40, (0.5,) * 3, (0.25,) * 3).shape == (3, 32, 32)
    assert np.allclose(images.resize(x.astype(float), 240, 300), x)
    near = np.clip(x.astype(int) + 2, 0, 255).astype(np.uint8)
    assert bin((images.perceptual_hash(x) ^ images.perceptual_hash(near)) & (2**64 - 1)).count("1") <= 8


def test_pages_that_are_read(spark):
    ids = list(range(7, 0, -1))
    rows = [("q", k, i, [f"p{i}a", f"p{i}b"] if i % 3 else None, None) for k, page in enumerate((ids[:3], ids[3:6], ids[6:])) for i in page]
    rows += [("gap", 0, i, ["x"], None) for i in range(3)] + [("gap", 2, 9, ["y"], None)]
    records = spark.createDataFrame(rows, "query string, page int, id int, photos array<string>, licence string")
    got = lambda q="q", **k: sorted((r["id"] for r in co.cursor_pages(records, per_page=3, **k).where(F.col("query") == q).collect()), reverse=True)
    assert got(need=3, max_photos=1) == [7, 5, 4, 2]  # the last page overshoots
    assert len(got(need=100, max_photos=1)) == 5 and len(got(need=None)) == 10 and got("gap", need=None) == [2, 1, 0]
    results = spark.createDataFrame([("q", i, "x" if i == 2 else str(i), None) for i in range(1, 1500)] + [("e", 31, "1", "1")], "query string, position int, width string, height string")
    read = co.sized(co.offset_pages(results, 30))
    assert read.count() == 1000 and tuple(read.where("position = 2").select("width", "height").first()) == (0, 0)  # a search without a first page gives nothing


def test_search_results(spark):
    wanted = spark.createDataFrame([("Cod",), ("eel",), ("ray",)], "query string")
    found = spark.createDataFrame([("Cod", 0, 9, "Codling"), ("Cod", 1, 8, "COD"), ("Cod", 2, 7, "cod"), ("eel", 0, 6, "eels"), ("eel", 1, 5, "moray"), ("ray", 10, 4, "ray")], "query string, place int, id int, name string")
    got = {r["query"]: (r["id"], r["seen"]) for r in co.exact_names(wanted, found).collect()}
    assert got == {"Cod": (8, None), "eel": (None, ["eels", "moray"]), "ray": (None, None)}
    rows = [(1, "a", 400, 400, True), (2, " ", 400, 400, True), (3, "b", 100, 400, True), (4, "c", 0, 0, False), (5, "bad", 400, 400, True), (6, "d", 400, 400, True), (7, "e", 400, 400, True), (8, None, None, None, True)]
    results = spark.createDataFrame([(q, *r) for q in "xy" for r in rows], "query string, place int, link string, width int, height int, ok boolean")
    counts = lambda want: {tuple(r) for r in co.fetch_counts(results, spark.createDataFrame([("bad",)], "link string"), want).collect()}
    assert counts(2) == {("x", 2, 3, 1), ("y", 2, 3, 1)} and counts(9) == {("x", 3, 4, 1), ("y", 3, 4, 1)}
    gains = spark.createDataFrame([("a", k, g) for k, g in enumerate((3, 1, 0, 5, 7))] + [("b", k, 2) for k in range(9)], "query string, pass int, gain int")
    assert sorted(tuple(r)[:2] for r in co.retry_offsets(gains, 5).collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 2)]


def test_scores_in_order_of_line(spark, tmp_path):
    (tmp_path / "s.csv").write_text("split,species,filename,fish_prob\ntrain,cod,a.png,0.9\ntrain,cod,b.png,0.1\ntrain,cod,a.png,0.2\ntrain,cod,b.png,0.8\n")
    scores = files.read_csv(spark, str(tmp_path / "s.csv"), files.SCORES, with_line=True)
    have = spark.createDataFrame([("cod", "a.png"), ("cod", "b.png"), ("cod", "c.png")], "class string, filename string")
    classes = spark.createDataFrame([("cod", 0)], "class string, idx int")
    kept = files.labelled_files(have, classes, scores, 0.5)
    assert {r["filename"]: r["fish_prob"] for r in kept.collect()} == {"b.png": 0.8, "c.png": 1.0}
    missing = files.read_csv(spark, str(tmp_path / "none.csv"), files.SCORES, with_line=True)
    assert missing.count() == 0 and files.image_files(spark, str(tmp_path / "none")).count() == 0
    for args in ((None, 0.5), (missing, 0.5)):
        try:
            files.labelled_files(have, classes, *args)
            raise AssertionError("a threshold without scores")
        except ValueError:
            pass


def test_side_keys_and_archive(spark, tmp_path):
    log = spark.createDataFrame([("", "a.jpg"), ("cod", ""), ("cod", "b.jpg"), ("cod", "b.jpg")], "species string, filename string")
    assert files.licence_keys(log).count() == 2 and files.manifest_keys(log).count() == 1
    put = lambda rows, names=None: files.write_manifest(spark.createDataFrame(rows, "species string, filename string"), str(tmp_path / "m"), names)
    now = lambda version=None: sorted(map(tuple, files.read_manifest(spark, str(tmp_path / "m"), version).select("species", "filename").collect()))
    assert now() == [] and put([("cod", "a"), ("eel", "b"), ("cod", "a"), ("", "x")]) == 1 and now() == [("cod", "a"), ("eel", "b")]
    assert put([("cod", "c")]) == 2 and now() == [("cod", "c"), ("eel", "b")]
    assert put([], ["cod"]) == 3 and now() == [("eel", "b")]  # an emptied class loses its rows
    assert put([("ray", "r"), ("cod", "z")], ["ray", "eel"]) == 4 and now() == [("ray", "r")]  # rows of classes that weren't named don't count
    assert put([], ["ray"]) == 5 and now() == [] and now(2) == [("cod", "c"), ("eel", "b")]
    spark.createDataFrame([("cod", "torn")], "species string, filename string").write.partitionBy("species").parquet(str(tmp_path / "m/version=6"))  # never committed
    assert now() == [] and put([("cod", "d")]) == 6 and now() == [("cod", "d")]
    files.archive(spark.createDataFrame([("train", bytearray(b"abc")), ("test", bytearray(b"d"))], "split string, content binary"), str(tmp_path / "z"))
    assert {(r["split"], r["files"], r["damaged"]) for r in files.verify_archive(spark, str(tmp_path / "z")).collect()} == {("train", 1, 0), ("test", 1, 0)}
    for name in ("p/a.HEIC", "p/b.txt", "p/c.jpg", "d.png", "e.csv"):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = files.picked_files(spark, [str(tmp_path / "p"), str(tmp_path / "d.png"), str(tmp_path / "e.csv")])
    assert sorted(r["filename"] for r in got.collect()) == ["a.HEIC", "c.jpg", "d.png"]
