"""Queries on pictures: documents stand in as files, with headers built from their ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanworks.functions.arrays import rounded
from gleanworks.plans.catalog import query
from gleanworks.session import table
from gleanworks.sources import headers, images


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.hex(value), digits, "0")


def _little(value: Column, size: int) -> Column:
    """A number's bytes in ascending order, as hexadecimal digits."""
    h = _hex(value, 2 * size)
    return F.concat(*(F.substring(h, 2 * i + 1, 2) for i in reversed(range(size))))


def files(spark, sf_dir):
    """(doc_id, content): GIF, BMP without rows, JPEG with EXIF and 70,000 bytes of preview, TIFF, text or an empty file, by doc_id mod 8."""
    i, lit = F.col("doc_id"), F.lit
    w, h = i % 9000 + 1, i * 7 % 8000 + 1
    jpeg = F.concat(
        lit("FFD8FFE10022" + "457869660000" + "49492A0008000000" + "0100" + "120103000100" + "0000"), _little(i % 10, 2), lit("0000" + "00000000"),
        lit("FFE2EA62"), F.repeat(lit("00"), 60000), lit("FFE22712"), F.repeat(lit("01"), 10000),
        lit("FFC0001108"), _hex(h, 4), _hex(w, 4), lit("03012200021101031101"), lit("FFDA0002"), lit("FFD9"),
    )
    content = (
        F.when(i % 8 == 0, F.concat(lit("474946383961"), _little(w, 2), _little(h, 2), lit("0000003B")))
        .when(i % 8 == 1, F.concat(lit("424D000000000000000036000000" + "28000000"), _little(w, 4), _little(h, 4), lit("01001800" + "00" * 24)))
        .when(i % 8 < 5, jpeg)
        .when(i % 8 == 5, F.concat(lit("49492A00080000000200" + "0001040001000000"), _little(w, 4), lit("0101040001000000"), _little(h, 4), lit("00000000")))
        .when(i % 8 == 6, F.hex(F.encode("text", "UTF-8")))
        .otherwise("")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.unhex(content).alias("content"))


@query("picture_headers", """WITH s AS (SELECT doc_id, doc_id % 8 AS k, doc_id % 9000 + 1 AS w, doc_id * 7 % 8000 + 1 AS h, strlen(coalesce(text, '')) AS size FROM documents),
f AS (SELECT *, CASE WHEN k = 0 THEN 'GIF' WHEN k = 1 THEN 'BMP' WHEN k < 5 THEN 'JPEG' WHEN k = 5 THEN 'TIFF' END AS format, CASE WHEN k BETWEEN 2 AND 4 AND doc_id % 10 BETWEEN 1 AND 8 THEN doc_id % 10 ELSE 1 END AS o FROM s),
e AS (SELECT *, CASE WHEN k = 7 OR (k = 6 AND size = 0) THEN 'EMPTY_FILE' WHEN k = 6 THEN 'IMAGE_DECODE_FAILED' WHEN k = 5 THEN 'UNSUPPORTED_FORMAT' WHEN w * h > 50000000 THEN 'IMAGE_TOO_LARGE' WHEN k = 1 OR least(w, h) < 2 THEN 'IMAGE_DECODE_FAILED' END AS error FROM f)
SELECT doc_id, format, CASE WHEN k < 6 THEN o END AS orientation, CASE WHEN k < 6 THEN CASE WHEN o >= 5 THEN h ELSE w END END AS shown_width, CASE WHEN k < 6 THEN CASE WHEN o >= 5 THEN w ELSE h END END AS shown_height, error,
  CASE coalesce(error, '') WHEN '' THEN 200 WHEN 'UNSUPPORTED_FORMAT' THEN 415 WHEN 'IMAGE_TOO_LARGE' THEN 413 ELSE 400 END AS status FROM e""")
def picture_headers(spark, sf_dir):
    """Serving's checks by header: size, orientation and the first error of each file."""
    out = headers.served_pictures(files(spark, sf_dir))
    return out.select("doc_id", "header.format", "header.orientation", "shown_width", "shown_height", "error", "status")


def _u(i: int) -> str:
    return f"CAST('0x' || substr(md5('7:3:' || doc_id || ':{i // 4}'), {8 * (i % 4) + 1}, 8) AS BIGINT) / 4294967296.0::DOUBLE"


@query("augmentation_draws", f"""WITH d AS (SELECT doc_id, greatest(1, n_chars) AS h, doc_id % 900 + 1 AS w, {_u(0)} AS scale, {_u(1)} AS ratio, {_u(2)} AS top, {_u(3)} AS lft, {_u(4)} AS flip, {_u(11)} AS noise FROM documents),
b AS (SELECT *, (scale * (1.0::DOUBLE - 0.55::DOUBLE) + 0.55::DOUBLE) * h * w AS area, ratio * (1.33::DOUBLE - 0.75::DOUBLE) + 0.75::DOUBLE AS r FROM d),
c AS (SELECT *, least(greatest(floor(sqrt(area / r)), 1), h)::INT AS ch, least(greatest(floor(sqrt(area * r)), 1), w)::INT AS cw FROM b)
SELECT doc_id, ch AS height, cw AS width, floor(top * (h - ch + 1))::INT AS top, floor(lft * (w - cw + 1))::INT AS lft, flip < 0.5 AS flip, round(noise, 9) AS noise FROM c""")
def augmentation_draws(spark, sf_dir):
    """The draws of epoch 3 and the crops they give, for pictures as large as the documents."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.greatest(F.lit(1), "n_chars").alias("h"), (F.col("doc_id") % 900 + 1).alias("w"), images.augmentation_draws(F.col("doc_id"), 7, 3).alias("d"))
    box = df.select("doc_id", "d", images.crop_box(F.col("h"), F.col("w"), F.col("d")).alias("b"))
    return box.select("doc_id", "b.height", "b.width", "b.top", F.col("b.left").alias("lft"), (F.col("d.flip") < 0.5).alias("flip"), rounded(F.col("d.noise"), 9).alias("noise"))


@query("model_planes", """WITH m AS (SELECT doc_id, md5(doc_id || 'a') || md5(doc_id || 'b') AS m FROM documents)
SELECT doc_id, flatten(list_transform([[0.5, 0.25], [0.25, 0.5], [0.125, 1.0]], lambda c: list_transform(range(36), lambda i: round((ascii(substr(m, ((i // 6 + 1) * 8 + i % 6 + 2)::BIGINT, 1)) - c[1] * 255) / (c[2] * 255), 5)::DOUBLE))) AS plane FROM m""")
def model_planes(spark, sf_dir):
    """Whole input tensors of small pictures: 8 x 8 grey, cropped to 6 x 6, normalised by channel."""
    i = F.col("doc_id").cast("string")
    pictures = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.md5(F.concat(i, F.lit("a"))), F.md5(F.concat(i, F.lit("b")))).cast("binary").alias("data"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"))
    out = images.model_inputs(pictures, 6, 8, [0.5, 0.25, 0.125], [0.25, 0.5, 1.0], key="doc_id")
    return out.select("doc_id", F.transform("plane", lambda x: rounded(x.cast("double"), 5)).alias("plane"))
