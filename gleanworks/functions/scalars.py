"""Scalar rules over file names, sizes, urls and scores; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the acceptance gate.
LEAST_BYTES, MOST_BYTES, LEAST_SIDE, MOST_ASPECT = 6144, 12_582_912, 200, 4.0
#: Image suffixes, open licences, url size tokens.
SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp")
LICENCES = ("cc0", "cc-by", "cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd")
SIZES = ("square", "small", "medium", "large", "original")


def gate_reason(n_bytes: Column, width: Column, height: Column, least_side: int = LEAST_SIDE) -> Column:
    """The first rule that an image breaks, or `ok`; a null side is an image that cannot be read."""
    low, high = F.least(width, height), F.greatest(width, height)
    small = F.concat(F.lit("small_"), width.cast("string"), F.lit("x"), height.cast("string"))
    return (
        F.when(n_bytes < LEAST_BYTES, "too_small_bytes")
        .when(n_bytes > MOST_BYTES, "too_large_bytes")
        .when(width.isNull() | height.isNull(), "decode_failed")
        .when(low < least_side, small)
        .when(high / F.greatest(F.lit(1), low) > MOST_ASPECT, "extreme_aspect")
        .otherwise("ok")
    )


def source_of(filename: Column) -> Column:
    return F.when(filename.startswith("inat_"), "inat").when(filename.startswith("web_"), "web").otherwise("other")


def suffix_of(filename: Column) -> Column:
    """The lower-cased last suffix with its dot; null without one."""
    return F.nullif(F.lower(F.regexp_extract(filename, r"(\.[^./]+)$", 1)), F.lit(""))


def observation_of(filename: Column) -> Column:
    return F.nullif(F.regexp_extract(filename, r"^inat_([0-9]+)_", 1), F.lit(""))


def photo_of(filename: Column) -> Column:
    return F.nullif(F.regexp_extract(filename, r"^inat_[0-9]+_([0-9]+)\.", 1), F.lit(""))


def leak_group(filename: Column, dup_group: Column) -> Column:
    """Observation first, then near-duplicate group, then the file itself."""
    return F.coalesce(F.concat(F.lit("obs"), observation_of(filename)), F.concat(F.lit("p"), dup_group.cast("string")), F.concat(F.lit("f"), filename))


def url_filename(url: Column) -> Column:
    return F.concat(F.lit("web_"), F.substring(F.sha1(F.encode(url, "UTF-8")), 1, 12), F.lit(".jpg"))


def resized_url(url: Column, size: str, tokens: tuple[str, ...] = SIZES) -> Column:
    """The first of the tokens that stands as `/token.` is replaced, once; else the url as it is."""
    out = url
    for t in reversed(tokens):
        at = F.instr(url, f"/{t}.")
        put = F.concat(F.substring(url, F.lit(1), at), F.lit(size), F.substring(url, at + 1 + len(t), F.length(url)))
        out = F.when(at > 0, put).otherwise(out)
    return out


def open_licence(code: Column, any_licence: bool = False) -> Column:
    return F.lit(True) if any_licence else F.coalesce(F.lower(code).isin(*LICENCES), F.lit(False))


def verdict(fish: Column, food: Column, text: Column, least_fish: float = 0.15, most_text: float = 0.20, most_food: float = 0.15) -> Column:
    return F.when(fish < least_fish, "suspicious").when(text > most_text, "overlay?").when(food > most_food, "food?").otherwise("keep")


def moves(verdict_: Column, strict: bool = False) -> Column:
    """Whether a file of this verdict is to be moved away: suspicious ones; with strict, overlay and food ones too."""
    return verdict_.isin("suspicious", "overlay?", "food?") if strict else verdict_ == "suspicious"


def ordered_unique(*words: Column) -> Column:
    """Trimmed, non-empty words in order of their first occurrence; the arguments are arrays."""
    return F.array_distinct(F.filter(F.transform(F.concat(*words), lambda x: F.trim(x)), lambda x: x != ""))


def resized_shape(height: Column, width: Column, target: int) -> tuple[Column, Column]:
    """(height, width) with the shorter side at target; sides round half to even, 1 at least."""
    scale = F.lit(float(target)) / F.least(height, width)
    side = lambda c: F.greatest(F.lit(1), F.bround(c * scale).cast("int"))
    return side(height), side(width)


def crop_offset(side: Column, size: int) -> Column:
    return F.floor((side - size) / 2).cast("int")


def need(limit: int, have: Column, least_web: int, have_web: Column) -> Column:
    """How many more are to be collected."""
    return F.greatest(F.lit(limit) - have, F.lit(least_web) - have_web, F.lit(0))


def per_keyword(need_: Column, keywords: Column, least: int = 10) -> Column:
    return F.greatest(F.lit(least), F.ceil(F.try_divide(need_, keywords)).cast("int"))


def over_fetch(need_: Column) -> Column:
    return F.floor(need_ * 1.6).cast("int") + 10


def deficit_per_keyword(limit: Column, ratio: float, have: Column, keywords: Column, least: int = 5) -> Column:
    """A bucket's fetch for each keyword: its share of the limit less what it has; null where nothing is missing."""
    missing = F.greatest(F.lit(0), F.floor(limit * ratio).cast("int") - have)
    return F.when(missing > 0, F.greatest(F.lit(least), F.ceil(F.try_divide(missing, keywords)).cast("int")))


def taxon_limit(limit: Column, ratio: float, taxa: Column, have_before: Column, least: int = 5) -> Column:
    """What a taxon may reach: what was there before and its share of the bucket."""
    return have_before + F.greatest(F.lit(least), F.floor(F.try_divide(F.floor(limit * ratio), taxa)).cast("int"))


#: Targets by difficulty.
TARGETS = {"easy": 350, "medium": 600, "hard": 1000}


def target_of(target: Column, difficulty: Column) -> Column:
    """The explicit target, else the difficulty's; null without either."""
    by = F.create_map(*(F.lit(x) for kv in TARGETS.items() for x in kv))
    return F.coalesce(target, F.try_element_at(by, difficulty))


def is_fish(habitat: Column) -> Column:
    return habitat != "other"


def class_text(name: Column, index: Column) -> Column:
    """A class's name, else `idx` and its number."""
    return F.coalesce(name, F.concat(F.lit("idx"), index.cast("string")))
