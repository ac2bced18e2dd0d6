"""Pictures by their headers: format, size and orientation before any pixel is decoded.

Five formats and TIFF are read straight from the bytes. For headers alone the first HEAD bytes of each
picture go to the parser, and only pictures whose header is longer (large colour profiles or previews come
before a JPEG's size) are sent whole. Serving sends each picture whole, once; only those without an error so far
are checked to their end. So the rule on pixels comes before the cost of the pixels.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanworks.sources.images import MOST_BYTES, MOST_PIXELS, status_of

HEAD = 1 << 16
#: Formats that are served, and the tags and markers of the formats' public descriptions.
SERVED = ("JPEG", "PNG", "GIF", "BMP", "WEBP")
ORIENTATION, WIDTH, HEIGHT = 0x0112, 0x0100, 0x0101
SIZE_MARKERS = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
ALONE_MARKERS = frozenset((0x01, *range(0xD0, 0xD9)))
HEADER = T.StructType([T.StructField("format", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in ("width", "height", "orientation")), T.StructField("short", T.BooleanType())])
CHECKED = T.StructType([*HEADER.fields[:4], T.StructField("whole", T.BooleanType()), T.StructField("size", T.IntegerType())])


class Short(Exception):
    """The bytes end before the header does."""


def _at(data: bytes, at: int, form: str) -> tuple:
    if at < 0 or at + struct.calcsize(form) > len(data):
        raise Short
    return struct.unpack_from(form, data, at)


def tiff_tags(data: bytes, start: int = 0, wanted: tuple[int, ...] = (ORIENTATION,)) -> dict[int, int]:
    """The short and long values of some tags in the first directory of a TIFF at `start`, as in EXIF too."""
    order = {b"II": "<", b"MM": ">"}.get(data[start : start + 2])
    if order is None or _at(data, start + 2, order + "H")[0] != 42:
        return {}
    at = start + _at(data, start + 4, order + "I")[0]
    out = {}
    for i in range(_at(data, at, order + "H")[0]):
        tag, kind, n = _at(data, at + 2 + 12 * i, order + "HHI")
        if tag in wanted and n == 1 and kind in (3, 4):
            out[tag] = _at(data, at + 10 + 12 * i, order + ("H" if kind == 3 else "I"))[0]
    return out


def _turned(data: bytes, start: int) -> int | None:
    """The orientation of EXIF data, which is ignored where it is broken."""
    try:
        return tiff_tags(data, start).get(ORIENTATION)
    except Short:
        return None


def _jpeg(data: bytes) -> tuple:
    at, size, turn = 2, None, None
    while True:
        mark, code = _at(data, at, ">BB")
        if mark != 0xFF:
            return (*(size or (None, None)), turn)
        if code == 0xFF or code in ALONE_MARKERS:  # fill bytes and markers without a body
            at += 1 if code == 0xFF else 2
            continue
        if code in (0xD9, 0xDA):  # the end, or the pixels
            return (*(size or (None, None)), turn)
        length = _at(data, at + 2, ">H")[0]
        if code in SIZE_MARKERS and size is None:
            size = _at(data, at + 5, ">HH")[::-1]
        if code == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0" and turn is None:
            _at(data, at + 1 + length, "B")
            turn = _turned(data[: at + 2 + length], at + 10)
        at += 2 + length


def _png(data: bytes) -> tuple:
    length, kind, width, height = _at(data, 8, ">I4sII")
    if kind != b"IHDR" or length != 13:
        return None, None, None
    at, turn = 33, None
    while True:
        length, kind = _at(data, at, ">I4s")
        if kind in (b"IDAT", b"IEND"):
            return width, height, turn
        if kind == b"eXIf":
            _at(data, at + 8 + length, "B")
            turn = _turned(data[: at + 8 + length], at + 8)
        at += 12 + length


def _gif(data: bytes) -> tuple:
    return (*_at(data, 6, "<HH"), None)


def _bmp(data: bytes) -> tuple:
    width, height = _at(data, 18, "<HH") if _at(data, 14, "<I")[0] == 12 else _at(data, 18, "<ii")
    return width, abs(height), None


def _webp(data: bytes) -> tuple:
    kind = _at(data, 12, "4s")[0]
    if kind == b"VP8 ":
        start, width, height = _at(data, 23, "<3sHH")
        return (width & 0x3FFF, height & 0x3FFF, None) if start == b"\x9d\x01\x2a" else (None, None, None)
    if kind == b"VP8L":
        sign, bits = _at(data, 20, "<BI")
        return ((bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1, None) if sign == 0x2F else (None, None, None)
    if kind != b"VP8X":
        return None, None, None
    flags, w, wide, h, high = _at(data, 20, "<B3xHBHB")
    turn, at = None, 30
    while flags & 8 and turn is None:  # EXIF comes after the pixels
        tag, length = _at(data, at, "<4sI")
        if tag == b"EXIF":
            _at(data, at + 7 + length, "B")
            body = at + 8 + (6 if data[at + 8 : at + 14] == b"Exif\0\0" else 0)
            turn = _turned(data[: at + 8 + length], body) or 1
        at += 8 + length + length % 2
    return (w | wide << 16) + 1, (h | high << 16) + 1, turn


def _tiff(data: bytes) -> tuple:
    tags = tiff_tags(data, 0, (WIDTH, HEIGHT, ORIENTATION))
    return tags.get(WIDTH), tags.get(HEIGHT), tags.get(ORIENTATION)


READERS: tuple[tuple[str, Callable[[bytes], bool], Callable[[bytes], tuple]], ...] = (
    ("JPEG", lambda d: d[:3] == b"\xff\xd8\xff", _jpeg),
    ("PNG", lambda d: d[:8] == b"\x89PNG\r\n\x1a\n", _png),
    ("GIF", lambda d: d[:6] in (b"GIF87a", b"GIF89a"), _gif),
    ("BMP", lambda d: d[:2] == b"BM", _bmp),
    ("WEBP", lambda d: d[:4] == b"RIFF" and d[8:12] == b"WEBP", _webp),
    ("TIFF", lambda d: d[:4] in (b"II*\0", b"MM\0*"), _tiff),
)


def parsed(data: bytes) -> tuple[str | None, int | None, int | None, int | None, bool]:
    """HEADER of a picture: no format where it can't be opened; short where its bytes end in the header."""
    for name, fits, read in READERS:
        if fits(data):
            try:
                width, height, turn = read(data)
            except Short:
                return None, None, None, None, True
            if not width or not height or width < 0:
                return None, None, None, None, False
            return name, width, height, turn if turn in range(1, 9) else 1, False
    return None, None, None, None, False


def whole(data: bytes, name: str) -> bool:
    """Whether a picture's bytes reach its end: checksums of PNG chunks and the size of its rows, else the format's own end."""
    try:
        if name == "PNG":
            at, packed = 8, zlib.decompressobj()
            while True:
                length, kind = _at(data, at, ">I4s")
                if zlib.crc32(data[at + 4 : at + 8 + length]) != _at(data, at + 8 + length, ">I")[0]:
                    return False
                if kind == b"IDAT":
                    packed.decompress(data[at + 8 : at + 8 + length])
                if kind == b"IEND":
                    return packed.eof
                at += 12 + length
        if name == "JPEG":
            return data.rstrip(b"\0").endswith(b"\xff\xd9")
        if name == "GIF":
            return data.rstrip(b"\0").endswith(b";")
        if name == "WEBP":
            return _at(data, 4, "<I")[0] + 8 <= len(data)
        core = _at(data, 14, "<I")[0] == 12
        width, height = _at(data, 18, "<HH") if core else _at(data, 18, "<ii")
        depth = _at(data, 24 if core else 28, "<H")[0]
        packed_rows = not core and _at(data, 30, "<I")[0] in (1, 2)
        start = _at(data, 10, "<I")[0]
        return start <= len(data) if packed_rows else start + (width * depth + 31) // 32 * 4 * abs(height) <= len(data)
    except (Short, zlib.error):
        return False


def _structs(rows: list[tuple], kind: T.StructType) -> pa.Array:
    fields = to_arrow_schema(kind)
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], fields=list(fields))


def _each(data: pa.Array) -> Iterator[bytes | None]:
    """The pictures of a batch, as Python's bytes one at a time."""
    return (x.as_py() for x in data)


@F.arrow_udf(HEADER)
def _header(data: pa.Array) -> pa.Array:
    return _structs([(None,) * 5 if d is None else parsed(d) for d in _each(data)], HEADER)


@F.arrow_udf(CHECKED)
def _checked(data: pa.Array, size: pa.Array) -> pa.Array:
    """All that serving asks of a picture: its header, its end where nothing is wrong before that, and the size it was given."""
    rows = []
    for d, n in zip(_each(data), size.to_pylist()):
        name, width, height, turn, _ = (None,) * 5 if d is None else parsed(d)
        opened = name in SERVED and width * height <= MOST_PIXELS
        rows.append((name, width, height, turn, whole(d, name) if opened else None, n))
    return _structs(rows, CHECKED)


def with_headers(df: DataFrame, content: str = "content", head: int = HEAD) -> DataFrame:
    """df with header struct<format, width, height, orientation> of its pictures, nulls in it where a picture can't be opened."""
    data = F.when(F.octet_length(content) <= MOST_BYTES, F.col(content))
    first = df.withColumn("_first", _header(F.substring(data, 1, head)))
    again = first.withColumn("_again", _header(F.when(F.col("_first.short") & (F.octet_length(content) > head), data)))
    fields = [F.coalesce(f"_first.{c}", f"_again.{c}").alias(c) for c in ("format", "width", "height", "orientation")]
    return again.withColumn("header", F.struct(*fields)).drop("_first", "_again")


def served_pictures(df: DataFrame, content: str = "content") -> DataFrame:
    """df with header, error (null if none), status, and shown_width and shown_height after turning by the orientation.

    The order of the errors is that of the steps: size of the upload, emptiness, opening, format,
    pixels by the header, then what decoding meets. Empty and null contents are alike. A picture goes to one
    worker once, and nothing after that asks for its bytes, so they wait in no other batch or queue."""
    data, size = F.when(F.octet_length(content) <= MOST_BYTES, F.col(content)), F.octet_length(content)
    seen = df.withColumn("_seen", _checked(data, size))
    seen = seen.withColumn("header", F.struct(*(F.col(f"_seen.{c}").alias(c) for c in ("format", "width", "height", "orientation"))))
    width, height, size = F.col("header.width"), F.col("header.height"), F.col("_seen.size")
    early = (
        F.when(size > MOST_BYTES, "FILE_TOO_LARGE")
        .when(F.coalesce(size, F.lit(0)) == 0, "EMPTY_FILE")
        .when(F.col("header.format").isNull(), "IMAGE_DECODE_FAILED")
        .when(~F.col("header.format").isin(*SERVED), "UNSUPPORTED_FORMAT")
        .when(width.cast("long") * height > MOST_PIXELS, "IMAGE_TOO_LARGE")
    )
    seen = seen.withColumn("_early", early)
    late = F.when(F.col("_early").isNull() & (~F.col("_seen.whole") | (F.least(width, height) < 2)), "IMAGE_DECODE_FAILED")
    out = seen.withColumn("error", F.coalesce("_early", late)).withColumn("status", status_of(F.col("error"))).drop("_early", "_seen")
    turned = F.col("header.orientation") >= 5
    return out.withColumn("shown_width", F.when(turned, height).otherwise(width)).withColumn("shown_height", F.when(turned, width).otherwise(height))
