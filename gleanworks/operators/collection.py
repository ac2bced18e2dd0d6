"""Rules of collecting from paged searches, over tables of what the searches gave: every query's pages in one job.

Which pages a collector reads, and which results it takes, follows from counts by page and by query; the
results themselves only meet those counts. Queries are independent, so a query with many results is
many rows of its pages and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the search services: records a page, and the last position that they give out.
PER_PAGE, MOST_DISPLAY, LAST_POSITION = 200, 100, 1000


def _pages(df: DataFrame, *sums: Column) -> DataFrame:
    return df.groupBy("query", "page").agg(F.count("*").alias("_rows"), *sums)


def cursor_pages(records: DataFrame, need: int | None, per_page: int = PER_PAGE, max_photos: int | None = None) -> DataFrame:
    """(query, id, photo, licence): the photos that a reader of records(query, page, id, photos, licence) collects.

    Pages go by number from 0 until `need` photos are there, after a short page, or before an absent one;
    the last page may bring more than needed. A record gives its first max_photos photos, one without any none."""
    photos = F.coalesce("photos", F.array().cast("array<string>"))
    records = records.withColumn("photos", photos if max_photos is None else F.slice(photos, 1, max_photos))
    pages = _pages(records, F.sum(F.size("photos")).alias("_photos"))
    before = Window.partitionBy("query").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("_photos").over(before), F.lit(0))
    full = F.coalesce(F.min((F.col("_rows") >= per_page).cast("int")).over(before), F.lit(1)) == 1
    there = F.col("page") == F.row_number().over(Window.partitionBy("query").orderBy("page")) - 1
    read = pages.withColumns({"_taken": taken, "_full": full, "_there": there}).where(F.col("_full") & F.col("_there") & (F.lit(True) if need is None else F.col("_taken") < need))
    return records.join(read.select("query", "page"), ["query", "page"]).select("query", "id", F.explode("photos").alias("photo"), "licence")


def offset_pages(results: DataFrame, display: int = MOST_DISPLAY, last: int = LAST_POSITION) -> DataFrame:
    """results(query, position, ...) that a reader by pages of `display` (100 at most) gets: up to position `last`, before the first empty page."""
    size = min(MOST_DISPLAY, display)
    rows = results.where(F.col("position").between(1, last)).withColumn("page", F.floor((F.col("position") - 1) / size))
    pages = _pages(rows).withColumn("_nth", F.row_number().over(Window.partitionBy("query").orderBy("page")) - 1)
    return rows.join(pages.where("page = _nth").select("query", "page"), ["query", "page"]).drop("page")


def sized(results: DataFrame) -> DataFrame:
    """results with whole-number width and height; what is none is 0."""
    whole = lambda c: F.coalesce(F.expr(f"try_cast({c} AS int)"), F.lit(0))
    return results.withColumns({"width": whole("width"), "height": whole("height")})


def exact_names(wanted: DataFrame, candidates: DataFrame, most: int = 10) -> DataFrame:
    """(query, id, seen): the first of a query's first `most` candidates whose name equals the query in any case, else null, and the first three names.

    wanted(query), candidates(query, place, id, name); places are unique in a query and from 0."""
    same = F.lower("name") == F.lower("query")
    near = candidates.where(F.col("place") < most)
    first = F.min(F.when(same, F.struct("place", "id")))["id"]
    # At most `most` names a query.
    seen = F.transform(F.slice(F.sort_array(F.collect_list(F.struct("place", "name"))), 1, 3), lambda s: s["name"])
    found = near.groupBy("query").agg(first.alias("id"), seen.alias("seen"))
    return wanted.join(found, "query", "left").withColumn("seen", F.when(F.col("id").isNull(), F.col("seen")))


def fetch_counts(results: DataFrame, rejected: DataFrame, want: int, least: int = 320) -> DataFrame:
    """(query, saved, skipped, failed) of results(query, place, link, width, height, ok) read in order until `want` are saved.

    Blank links, sizes that are known and under `least`, and links in rejected(link) are skipped. A query has LAST_POSITION results at most."""
    small = ((F.col("width") > 0) & (F.col("width") < least)) | ((F.col("height") > 0) & (F.col("height") < least))
    df = results.join(rejected.select("link", F.lit(True).alias("_out")).distinct(), "link", "left")
    skip = (F.coalesce(F.trim("link"), F.lit("")) == "") | F.coalesce(small, F.lit(False)) | F.coalesce("_out", F.lit(False))
    df = df.withColumn("said", F.when(skip, "skipped").when(F.col("ok"), "saved").otherwise("failed"))
    before = F.count_if(F.col("said") == "saved").over(Window.partitionBy("query").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    read = df.withColumn("before", before).where(F.col("before") < want)
    return read.groupBy("query").agg(*(F.count_if(F.col("said") == s).alias(s) for s in ("saved", "skipped", "failed")))


def retry_offsets(gains: DataFrame, stop_at: int, step: int = 120, passes: int = 4, last: int = LAST_POSITION) -> DataFrame:
    """(query, pass, gain): the passes that a crawler makes over gains(query, pass, gain), passes from 0 at offset step * pass.

    It stops before a pass once stop_at are gained, after one without gain, at the last position, and after `passes`."""
    before = Window.partitionBy("query").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    total, least = F.coalesce(F.sum("gain").over(before), F.lit(0)), F.coalesce(F.min("gain").over(before), F.lit(1))
    rows = gains.where((F.col("pass") < passes) & (F.col("pass") * step < last))
    return rows.withColumns({"_total": total, "_least": least}).where((F.col("_total") < stop_at) & (F.col("_least") > 0)).select("query", "pass", "gain")
