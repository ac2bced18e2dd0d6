"""Audit queries: scores of events and documents, and a metric history."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanworks.functions.arrays import rounded
from gleanworks.operators import audit as au
from gleanworks.plans.catalog import query
from gleanworks.session import table

#: The thresholds of the two reports.
KEEP = [0.01, 0.02, 0.05, 0.10, 0.15, 0.20, 0.30]
DROP = [0.02, 0.05, 0.10, 0.15, 0.20, 0.30, 0.40]


def _values(values) -> str:
    return f"(SELECT UNNEST([{', '.join(map(repr, values))}]) AS t)"


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("value") / 100).alias("score"))


@query("score_deciles", """WITH r AS (SELECT value / 100 AS score, event_type, row_number() OVER (ORDER BY value / 100, event_id) - 1 AS rn, greatest(count(*) OVER () // 10, 1) AS size FROM events)
SELECT CAST(least(rn // size, 9) AS INT) AS bucket, count(*) AS n, min(score) AS low, max(score) AS high, avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) AS top1, avg(CASE WHEN event_type IN ('click', 'view') THEN 1.0 ELSE 0.0 END) AS top3 FROM r GROUP BY 1""")
def score_deciles(spark, sf_dir):
    hits = {"top1": F.col("event_type") == "click", "top3": F.col("event_type").isin("click", "view")}
    return au.score_buckets(events(spark, sf_dir), "score", ["event_id"], hits)


@query("source_summary", "SELECT source, count(*) AS n, avg(CASE WHEN toxic = 0 THEN 1.0 ELSE 0.0 END) AS hit, avg(CAST(quality AS DOUBLE)) AS mean_score FROM documents JOIN labels USING (doc_id) GROUP BY source")
def source_summary(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return au.summary_by(df, "source", F.col("quality").cast("double"), F.col("toxic") == 0)


@query("keep_drop_tradeoff", f"""SELECT t, avg(CASE WHEN s >= t THEN 0.0 ELSE 1.0 END) AS drop_share, avg(h) FILTER (s >= t) AS kept_hit, CASE WHEN count(*) FILTER (s < t) = 0 THEN CAST('nan' AS DOUBLE) ELSE avg(h) FILTER (s < t) END AS dropped_hit
FROM (SELECT value / 100 AS s, CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END AS h FROM events) CROSS JOIN {_values(KEEP)} GROUP BY t HAVING count(*) FILTER (s >= t) > 0""")
def keep_drop_tradeoff(spark, sf_dir):
    return au.keep_drop(events(spark, sf_dir), "score", F.col("event_type") == "click", KEEP)


@query("drop_by_threshold", f"""SELECT source, t, count(*) FILTER (s < t) AS dropped, avg(CASE WHEN s < t THEN 1.0 ELSE 0.0 END) AS share
FROM (SELECT source, (doc_id * 37 % 101) / 100 AS s FROM documents JOIN labels USING (doc_id)) CROSS JOIN {_values(DROP)} GROUP BY source, t""")
def drop_by_threshold(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    return au.drops(df.withColumn("score", F.col("doc_id") * 37 % 101 / 100), "source", "score", DROP)


@query("worst_dropping_classes", f"""SELECT lang AS class, count(*) FILTER (s < 0.3) AS dropped, avg(CASE WHEN s < 0.3 THEN 1.0 ELSE 0.0 END) AS share
FROM (SELECT lang, (doc_id * 37 % 101) / 100 AS s FROM documents) GROUP BY lang ORDER BY share DESC, lang LIMIT 8""")
def worst_dropping_classes(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(F.col("lang").alias("class"), (F.col("doc_id") * 37 % 101 / 100).alias("score"))
    return au.drops(df, "class", "score", [0.3]).orderBy(F.col("share").desc(), "class").limit(8).drop("t")


@query("early_stop_trace", """WITH h AS (SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS score FROM events GROUP BY 1),
b AS (SELECT *, coalesce(max(score) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS best_before, row_number() OVER (ORDER BY day) AS rn FROM h),
c AS (SELECT *, score > best_before AS improved FROM b), d AS (SELECT *, CAST(rn - coalesce(max(CASE WHEN improved THEN rn END) OVER (ORDER BY day), 0) AS BIGINT) AS bad FROM c)
SELECT CAST(day AS VARCHAR) AS day, score, best_before, improved, bad, coalesce(max(CASE WHEN bad >= 8 THEN 1 ELSE 0 END) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1, false) AS stopped FROM d""")
def early_stop_trace(spark, sf_dir):
    """A metric history of one row a day: the best so far and where training would stop."""
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(rounded(F.avg("value"), 6).alias("score"))
    return au.early_stop(days, "day", "score", 8)
