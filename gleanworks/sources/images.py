"""Image operators: decoding errors, perceptual hashes, model input tensors."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The error codes of serving and their HTTP status.
ERRORS = {"EMPTY_FILE": 400, "IMAGE_DECODE_FAILED": 400, "UNSUPPORTED_FORMAT": 415, "IMAGE_TOO_LARGE": 413, "FILE_TOO_LARGE": 413, "MODEL_NOT_LOADED": 503, "INTERNAL_ERROR": 500}
MOST_PIXELS, MOST_BYTES = 50_000_000, 10 << 20
#: The first bytes of known formats, and whether serving takes them.
MAGIC = (("JPEG", "FFD8FF", True), ("PNG", "89504E470D0A1A0A", True), ("GIF", "47494638", True), ("BMP", "424D", True), ("WEBP", "52494646", True), ("TIFF", "49492A00", False), ("TIFF", "4D4D002A", False))


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, height, width, channels, data) by Spark's image source; what it cannot read has height -1."""
    df = spark.read.format("image").option("recursiveFileLookup", "true").load(root)
    return df.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def image_format(content: Column) -> Column:
    head, out = F.hex(F.substring(content, 1, 12)), F.lit(None).cast("string")
    for name, magic, _ in reversed(MAGIC):
        fits = head.startswith(magic) & (F.substring(head, 17, 8) == "57454250" if name == "WEBP" else F.lit(True))
        out = F.when(fits, name).otherwise(out)
    return out


def serving_error(content: Column, width: Column, height: Column) -> Column:
    """The first error of a request, or null: size, emptiness, format, pixels, then decoding."""
    kind = image_format(content)
    known = kind.isin(*{name for name, _, ok in MAGIC if ok})
    return (
        F.when(F.octet_length(content) > MOST_BYTES, "FILE_TOO_LARGE")
        .when(content.isNull() | (F.octet_length(content) == 0), "EMPTY_FILE")
        .when(kind.isNull(), "IMAGE_DECODE_FAILED")
        .when(~known, "UNSUPPORTED_FORMAT")
        .when(width.cast("long") * height > MOST_PIXELS, "IMAGE_TOO_LARGE")
        .when(width.isNull() | (F.least(width, height) < 2), "IMAGE_DECODE_FAILED")
    )


def status_of(error: Column) -> Column:
    table = F.create_map(*(x for k, v in ERRORS.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.element_at(table, error), F.lit(200))


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Blue-green-red bytes as an RGB array."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(x, 3, 2) if channels == 1 else x[:, :, 2::-1]


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, sample points at pixel centres."""
    for axis, n in ((0, height), (1, width)):
        at = np.clip((np.arange(n) + 0.5) * x.shape[axis] / n - 0.5, 0, x.shape[axis] - 1)
        low = np.floor(at).astype(int)
        high, part = np.minimum(low + 1, x.shape[axis] - 1), at - low
        part = part.reshape([-1 if a == axis else 1 for a in range(x.ndim)])
        x = np.take(x, low, axis) * (1 - part) + np.take(x, high, axis) * part
    return x


#: The weights of grey in 1 / 65536, and the bits of a filter's fixed-point weights.
GREY, WEIGHT_BITS = (19595, 38470, 7471), 22


def grey(x: np.ndarray) -> np.ndarray:
    """Eight-bit grey of an RGB array, in fixed point."""
    return (x.astype(np.int64) @ np.array(GREY) + 0x8000 >> 16).astype(np.uint8)


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


def lanczos_resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Antialiased resampling of a grey eight-bit picture: the window widens with the reduction, columns before rows, weights in fixed point, each pass rounded to eight bits."""
    for axis, n in ((1, width), (0, height)):
        have = x.shape[axis]
        if have == n:
            continue
        scale = have / n
        wide = max(scale, 1.0)
        weights = np.zeros((n, have), np.int64)
        for i in range(n):
            centre, reach = (i + 0.5) * scale, 3 * wide
            low, high = max(int(centre - reach + 0.5), 0), min(int(centre + reach + 0.5), have)
            w = _lanczos((np.arange(low, high) - centre + 0.5) / wide)
            w = w / w.sum() * (1 << WEIGHT_BITS)
            weights[i, low:high] = np.trunc(w + np.where(w < 0, -0.5, 0.5))
        moved = np.moveaxis(x.astype(np.int64), axis, 0)
        out = weights @ moved + (1 << WEIGHT_BITS - 1) >> WEIGHT_BITS
        x = np.moveaxis(np.clip(out, 0, 255), 0, axis).astype(np.uint8)
    return x


def perceptual_hash(x: np.ndarray, side: int = 8, scale: int = 4) -> int:
    """64 bits, the first the highest: which of the low 8 x 8 frequencies of the 32 x 32 grey picture (DCT-II) exceed their median."""
    n = side * scale
    small = lanczos_resize(grey(x), n, n).astype(np.float64)
    basis = 2 * np.cos(np.pi * (2 * np.arange(n)[None, :] + 1) * np.arange(side)[:, None] / (2 * n))
    low = basis @ small @ basis.T
    bits = (low > np.median(low)).ravel()
    return int(np.packbits(bits).view(">u8")[0].astype(np.uint64).view(np.int64))


@F.pandas_udf(T.LongType())
def phash(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
    """Null for pictures that are broken: a side under 200 or an aspect over 4."""

    def one(d, h, w, c):
        if d is None or min(h, w) < 200 or max(h, w) / max(1, min(h, w)) > 4:
            return None
        return perceptual_hash(pixels(d, h, w, c))

    return pd.Series([one(*row) for row in zip(data, height, width, channels)], dtype="Int64")


def model_input(x: np.ndarray, size: int, shorter: int, mean, std) -> np.ndarray:
    """Shorter side to `shorter`, centre crop of `size`, normalised, channels first."""
    h, w = x.shape[:2]
    scale = shorter / min(h, w)
    x = resize(x.astype(np.float64), max(1, round(h * scale)), max(1, round(w * scale)))
    top, left = (x.shape[0] - size) // 2, (x.shape[1] - size) // 2
    x = x[top : top + size, left : left + size]
    return ((x - np.array(mean) * 255) / (np.array(std) * 255)).transpose(2, 0, 1).astype(np.float32)


#: Limits of the augmentation: share of the area, aspect, shift and share of rows that get it.
CROP_SCALE, CROP_RATIO, LIGHT, LIGHT_SHARE, TURN, TURN_SHARE, NOISE, NOISE_SHARE = (0.55, 1.0), (0.75, 1.33), 0.25, 0.7, 15.0, 0.5, (0.03, 0.12), 0.25
DRAWN = ("scale", "ratio", "top", "left", "flip", "lit", "brightness", "contrast", "turned", "angle", "noisy", "noise")


def augmentation_draws(key: Column, seed: int, epoch: int | Column) -> Column:
    """struct of DRAWN, each uniform in [0, 1): by counter from (seed, epoch, key) alone, so no partition or order matters."""
    at = F.concat_ws(":", F.lit(str(seed)), (F.lit(epoch) if isinstance(epoch, int) else epoch).cast("string"), key.cast("string"))
    digits = F.concat(*(F.md5(F.concat(at, F.lit(f":{i}"))) for i in range(3)))
    number = lambda i: F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") / float(1 << 32)
    return F.struct(*(number(i).alias(name) for i, name in enumerate(DRAWN)))


def crop_box(height: Column, width: Column, draws: Column) -> Column:
    """struct<height, width, top, left>: a part of the picture of the drawn area and aspect, within its sides."""
    area = (draws["scale"] * (CROP_SCALE[1] - CROP_SCALE[0]) + CROP_SCALE[0]) * height * width
    ratio = draws["ratio"] * (CROP_RATIO[1] - CROP_RATIO[0]) + CROP_RATIO[0]
    side = lambda c, most: F.least(F.greatest(F.floor(F.sqrt(c)), F.lit(1)), most).cast("int")
    h, w = side(area / ratio, height), side(area * ratio, width)
    place = lambda c, most, own: F.floor(draws[c] * (most - own + 1)).cast("int")
    return F.struct(h.alias("height"), w.alias("width"), place("top", height, h).alias("top"), place("left", width, w).alias("left"))


def augmented(x: np.ndarray, box: dict, draws: dict, size: int) -> np.ndarray:
    """The training view of an RGB array: crop to size, flip, turn, light and noise by its draws."""
    x = resize(x[box["top"] : box["top"] + box["height"], box["left"] : box["left"] + box["width"]].astype(np.float64), size, size)
    if draws["flip"] < 0.5:
        x = x[:, ::-1]
    if draws["turned"] < TURN_SHARE:
        angle = np.deg2rad((2 * draws["angle"] - 1) * TURN)
        mid = (size - 1) / 2
        r, c = np.mgrid[:size, :size] - mid
        at = [np.clip(np.rint(a + mid), 0, size - 1).astype(int) for a in (np.cos(angle) * r - np.sin(angle) * c, np.sin(angle) * r + np.cos(angle) * c)]
        x = x[at[0], at[1]]
    if draws["lit"] < LIGHT_SHARE:
        x = x * (1 + (2 * draws["contrast"] - 1) * LIGHT) + (2 * draws["brightness"] - 1) * LIGHT * 255
    if draws["noisy"] < NOISE_SHARE:
        spread = NOISE[0] + draws["noise"] * (NOISE[1] - NOISE[0])
        x = x + np.random.Generator(np.random.Philox(key=int(draws["noise"] * (1 << 32)))).normal(0, spread * 255, x.shape)
    return np.clip(x, 0, 255)


def model_inputs(df: DataFrame, size: int, shorter: int, mean: list[float], std: list[float], key: str = "id", seed: int | None = None, epoch: int = 0) -> DataFrame:
    """(key, plane array<float>): the input tensor of each picture(key, data, height, width, channels), channels first; null where it can't be made.

    Without a seed the evaluation view: shorter side, centre crop. With one the training view of that epoch, by draws from
    (seed, epoch, key). A plane is large, so rows leave a task a few at a time. A picture that is smaller than the crop has no evaluation view."""
    draws = F.lit(None).cast("struct<x:int>") if seed is None else augmentation_draws(F.col(key), seed, epoch)
    rows = df.select(F.col(key).alias("key"), "data", "height", "width", "channels", draws.alias("draws"))
    box = F.lit(None).cast("struct<x:int>") if seed is None else crop_box(F.col("height"), F.col("width"), F.col("draws"))
    rows = rows.withColumn("box", box)
    kind, most = dict(rows.dtypes)["key"], max(1, (8 << 20) // (12 * size * size))

    def plane(r: dict) -> np.ndarray | None:
        if r["data"] is None or not r["height"] or not r["width"] or min(r["height"], r["width"]) < 1 or len(r["data"]) != r["height"] * r["width"] * r["channels"]:
            return None
        x = pixels(r["data"], r["height"], r["width"], r["channels"])
        if seed is None:
            out = model_input(x, size, shorter, mean, std)
            return out if out.shape == (3, size, size) else None
        out = augmented(x, r["box"], r["draws"], size)
        return ((out - np.array(mean) * 255) / (np.array(std) * 255)).transpose(2, 0, 1).astype(np.float32)

    def made(batches):
        for batch in batches:
            for at in range(0, len(batch), most):
                part = batch.slice(at, most).to_pylist()
                planes = [None if (x := plane(r)) is None else x.ravel() for r in part]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(at, most), pa.array(planes, pa.list_(pa.float32()))], ["key", "plane"])

    return rows.mapInArrow(made, f"key {kind}, plane array<float>").withColumnRenamed("key", key)


def max_abs_diff(a: Column, b: Column) -> Column:
    """The largest difference of two arrays."""
    return F.array_max(F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: F.abs(p["a"] - p["b"])))
