"""Headers of planted pictures, and the order of serving's errors."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from gleanworks.sources import headers, images


def png(w, h, turn=None, rows=None, crc=0):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d) ^ crc)
    exif = b"" if turn is None else chunk(b"eXIf", tiff(">", {0x0112: turn}))
    pixels = zlib.compress(b"".join(b"\0" + bytes(3 * w) for _ in range(h if rows is None else rows)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + exif + chunk(b"IDAT", pixels) + chunk(b"IEND", b"")


def tiff(order, tags):
    head = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "IH", 8, len(tags))
    return head + b"".join(struct.pack(order + "HHIHH", t, 3, 1, v, 0) for t, v in tags.items()) + bytes(4)


def jpeg(w, h, turn=None, order="<", preview=0, sof=0xC0, end=b"\xff\xd9"):
    part = lambda code, body: bytes([0xFF, code]) + struct.pack(">H", len(body) + 2) + body
    exif = b"" if turn is None else part(0xE1, b"Exif\0\0" + tiff(order, {0x0112: turn}))
    more = b"".join(part(0xE2, bytes(min(60_000, preview - at))) for at in range(0, preview, 60_000))
    return b"\xff\xd8" + exif + more + b"\xff\xff" + part(sof, struct.pack(">BHHB", 8, h, w, 1) + bytes(3))[1:] + part(0xDA, b"") + b"\x11\xff\x00\x22" + end


def webp(kind, body):
    chunk = kind + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    return chunk


def riff(*chunks):
    body = b"WEBP" + b"".join(chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def bmp(w, h, core=False, rows=None):
    info = struct.pack("<IHHHH", 12, w, h, 1, 24) if core else struct.pack("<IiiHHIIIIII", 40, w, h, 1, 24, 0, 0, 0, 0, 0, 0)
    return b"BM" + struct.pack("<IHHI", 0, 0, 0, 14 + len(info)) + info + bytes((w * 3 + 3) // 4 * 4 * (abs(h) if rows is None else rows))


gif = lambda w, h: b"GIF89a" + struct.pack("<HHBBB", w, h, 0, 0, 0) + b";"
extended = lambda w, h, *more: riff(webp(b"VP8X", bytes([8 * bool(more), 0, 0, 0]) + (w - 1).to_bytes(3, "little") + (h - 1).to_bytes(3, "little")), webp(b"VP8 ", bytes(30)), *more)

CASES = [
    (png(3, 4), ("PNG", 3, 4, 1)), (png(3, 4, 6), ("PNG", 3, 4, 6)), (png(3, 4, 9), ("PNG", 3, 4, 1)),
    (jpeg(640, 480), ("JPEG", 640, 480, 1)), (jpeg(640, 480, 6), ("JPEG", 640, 480, 6)), (jpeg(640, 480, 8, ">", 200_000, 0xC2), ("JPEG", 640, 480, 8)),
    (gif(7, 9), ("GIF", 7, 9, 1)), (bmp(5, -6), ("BMP", 5, 6, 1)), (bmp(5, 6, True), ("BMP", 5, 6, 1)),
    (riff(webp(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 0x4000 | 300, 200))), ("WEBP", 300, 200, 1)),
    (riff(webp(b"VP8L", b"\x2f" + struct.pack("<I", 299 | 199 << 14))), ("WEBP", 300, 200, 1)),
    (extended(70_000, 20), ("WEBP", 70_000, 20, 1)), (extended(70, 20, webp(b"EXIF", b"Exif\0\0" + tiff(">", {0x0112: 3}))), ("WEBP", 70, 20, 3)),
    (tiff("<", {0x0100: 8, 0x0101: 9, 0x0112: 5}), ("TIFF", 8, 9, 5)), (b"II*\0\xff\xff\xff\x7f", (None,) * 4), (b"II*\0", (None,) * 4),
    (png(3, 4)[:20], (None,) * 4), (jpeg(640, 480, 6, preview=900)[:200], (None,) * 4), (png(0, 4), (None,) * 4), (b"text", (None,) * 4), (b"RIFFxxxxWAVE", (None,) * 4), (b"\xff\xd8\xff\xd9", (None,) * 4),
]


def test_headers_of_all_formats(spark):
    df = spark.createDataFrame([(i, bytearray(c)) for i, (c, _) in enumerate(CASES)] + [(99, None)], "i int, content binary").withColumn("header", F.lit("mine"))
    for head in (headers.HEAD, 40):  # with 40 bytes most are read again
        got = {r["i"]: tuple(r["header"]) for r in headers.with_headers(df, head=head).collect()}
        assert got == {**{i: want for i, (_, want) in enumerate(CASES)}, 99: (None,) * 4}


@pytest.mark.parametrize("turn, order", [(t, o) for t in range(10) for o in "<>"])
def test_orientations(turn, order):
    assert headers.parsed(jpeg(3, 2, turn, order)) == ("JPEG", 3, 2, turn if 1 <= turn <= 8 else 1, False)


def test_errors_in_order(spark):
    over = images.MOST_BYTES + 1
    cases = [
        (bytes(over), "FILE_TOO_LARGE"), (b"", "EMPTY_FILE"), (None, "EMPTY_FILE"), (b"nothing known", "IMAGE_DECODE_FAILED"), (b"II*\0" + bytes(2), "IMAGE_DECODE_FAILED"),
        (tiff("<", {0x0100: 30_000, 0x0101: 30_000}), "UNSUPPORTED_FORMAT"), (jpeg(10_000, 5_001, end=b""), "IMAGE_TOO_LARGE"), (png(20_000, 20_000, rows=1), "IMAGE_TOO_LARGE"), (jpeg(10_000, 5_000), None),
        (jpeg(9, 9, end=b""), "IMAGE_DECODE_FAILED"), (png(9, 9, crc=1), "IMAGE_DECODE_FAILED"), (png(9, 9)[:-20], "IMAGE_DECODE_FAILED"), (bmp(9, 9, rows=8), "IMAGE_DECODE_FAILED"), (gif(9, 9)[:-1], "IMAGE_DECODE_FAILED"),
        (png(1, 9), "IMAGE_DECODE_FAILED"), (png(2, 9, 6), None), (bmp(9, 9), None), (gif(9, 9), None), (extended(70, 20), None), (extended(70, 20)[:-3], "IMAGE_DECODE_FAILED"),
    ]
    df = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, (c, _) in enumerate(cases)], "i int, content binary")
    rows = headers.served_pictures(df).orderBy("i").collect()
    assert [r["error"] for r in rows] == [e for _, e in cases]
    assert [r["status"] for r in rows] == [200 if e is None else images.ERRORS[e] for _, e in cases]
    assert (rows[15]["shown_width"], rows[15]["shown_height"]) == (9, 2)
    assert headers.served_pictures(df.limit(0)).count() == 0


def test_serving_sends_a_picture_once(spark):
    """One evaluation in Python, whose rows carry no content on; each more would hold batches of its own."""
    df = spark.createDataFrame([(i, bytearray(c)) for i, (c, _) in enumerate(CASES)], "i int, content binary")
    out = headers.served_pictures(df).select("i", "header", "error", "status", "shown_width", "shown_height")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") == 1
    above = plan[: plan.index("EvalPython")]
    assert "content" not in above
