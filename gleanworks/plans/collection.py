"""Queries of collecting: a user's events stand in for a search's results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanworks.operators import collection as co
from gleanworks.plans.catalog import query
from gleanworks.session import table

_EVENTS = "WITH e AS (SELECT user_id AS query, event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS place FROM events)"


def results(spark, sf_dir):
    """(query, id, place): a user's events, latest first, places from 0."""
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("event_id"))) - 1
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("query"), F.col("event_id").alias("id"), nth.alias("place"))


@query("cursor_pages", _EVENTS + """, r AS (SELECT *, place // 4 AS page, least(id % 4, 2) AS photos FROM e), p AS (SELECT query, page, count(*) AS n, sum(photos) AS k FROM r GROUP BY 1, 2),
w AS (SELECT *, coalesce(sum(k) OVER b, 0) AS taken, coalesce(min(n) OVER b, 4) AS least FROM p WINDOW b AS (PARTITION BY query ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT r.query, r.id, 'p' || r.id || '_' || i AS photo, 'cc0' AS licence FROM r JOIN w ON w.query = r.query AND w.page = r.page, range(2) AS v(i) WHERE taken < 9 AND least >= 4 AND i < r.photos""")
def cursor_pages(spark, sf_dir):
    """Pages of four records until nine photos, two a record at most."""
    df = results(spark, sf_dir)
    photos = F.transform(F.sequence(F.lit(0), (F.col("id") % 4).cast("int")), lambda i: F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("_"), i.cast("string")))
    records = df.select("query", F.floor(F.col("place") / 4).alias("page"), "id", F.when(F.col("id") % 4 > 0, F.slice(photos, F.lit(1), (F.col("id") % 4).cast("int"))).alias("photos"), F.lit("cc0").alias("licence"))
    return co.cursor_pages(records, 9, per_page=4, max_photos=2)


@query("offset_pages", _EVENTS + """, r AS (SELECT query, id, place + 1 + CASE WHEN place >= 7 AND query % 2 = 0 THEN 10 ELSE 0 END AS position FROM e)
SELECT query, id, position, coalesce(TRY_CAST(CASE id % 3 WHEN 0 THEN id::VARCHAR WHEN 1 THEN 'x' END AS INT), 0) AS width, 0 AS height FROM r WHERE position <= CASE WHEN query % 2 = 0 THEN 7 ELSE 12 END""")
def offset_pages(spark, sf_dir):
    """Pages of five results up to position 12; half of the searches have nothing at 8 to 17, so their third page is empty and ends them."""
    gap = F.when((F.col("place") >= 7) & (F.col("query") % 2 == 0), 10).otherwise(0)
    df = results(spark, sf_dir).withColumn("position", F.col("place") + 1 + gap).drop("place")
    width = F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).when(F.col("id") % 3 == 1, "x")
    return co.sized(co.offset_pages(df.withColumns({"width": width, "height": F.lit(None).cast("string")}), 5, 12)).select("query", "id", "position", "width", "height")


@query("exact_names", """WITH c AS (SELECT lower(n_name) AS query, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) - 1 AS place, s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN n_name ELSE s_name END AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
k AS (SELECT query, min(place) FILTER (lower(name) = query) AS hit, list(name ORDER BY place)[1:3] AS seen FROM c WHERE place < 10 GROUP BY query)
SELECT lower(n_name) AS query, c.id, CASE WHEN c.id IS NULL THEN array_to_string(seen, '|') END AS seen FROM nation LEFT JOIN k ON k.query = lower(n_name) LEFT JOIN c ON c.query = k.query AND c.place = k.hit""")
def exact_names(spark, sf_dir):
    """Each nation looked up among its suppliers, some of which bear its name."""
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    candidates = rows.select(F.lower("n_name").alias("query"), place.alias("place"), F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 4 == 0, F.col("n_name")).otherwise(F.col("s_name")).alias("name"))
    return co.exact_names(nation.select(F.lower("n_name").alias("query")), candidates).withColumn("seen", F.array_join("seen", "|"))


@query("fetch_counts", _EVENTS + """, r AS (SELECT *, CASE WHEN id % 7 = 0 THEN ' ' ELSE 'l' || id END AS link, id * 13 % 900 AS width, id % 5 > 0 AS ok FROM e),
s AS (SELECT *, CASE WHEN trim(link) = '' OR (width > 0 AND width < 320) OR id % 9 = 4 THEN 'skipped' WHEN ok THEN 'saved' ELSE 'failed' END AS said FROM r),
b AS (SELECT *, count(*) FILTER (said = 'saved') OVER (PARTITION BY query ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT query, count(*) FILTER (said = 'saved') AS saved, count(*) FILTER (said = 'skipped') AS skipped, count(*) FILTER (said = 'failed') AS failed FROM b WHERE before < 3 GROUP BY query""")
def fetch_counts(spark, sf_dir):
    """Three results a user wanted; blank and rejected links and small pictures are skipped."""
    df = results(spark, sf_dir)
    i = F.col("id")
    df = df.withColumns({"link": F.when(i % 7 == 0, " ").otherwise(F.concat(F.lit("l"), i.cast("string"))), "width": (i * 13 % 900).cast("int"), "height": F.lit(0), "ok": i % 5 > 0})
    return co.fetch_counts(df, df.where("id % 9 = 4 AND trim(link) <> ''").select("link"), 3)


@query("retry_offsets", """WITH g AS (SELECT user_id AS query, event_id % 6 AS pass, count(*) FILTER (event_type = 'click') AS gain FROM events GROUP BY 1, 2),
w AS (SELECT *, coalesce(sum(gain) OVER b, 0) AS total, coalesce(min(gain) OVER b, 1) AS least FROM g WHERE pass < 4 WINDOW b AS (PARTITION BY query ORDER BY pass ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT query, pass, gain FROM w WHERE total < 5 AND least > 0""")
def retry_offsets(spark, sf_dir):
    """Passes over each user's search until five clicks."""
    gains = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("query"), (F.col("event_id") % 6).alias("pass")).agg(F.count_if(F.col("event_type") == "click").alias("gain"))
    return co.retry_offsets(gains, 5)
