"""Evaluation queries on the embeddings table: 10 x the first ten dimensions are the logits, class 9 is `other`."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gleanworks.functions.arrays import group_sum, rounded
from gleanworks.operators import evaluation as ev
from gleanworks.plans.catalog import query
from gleanworks.session import table

OTHER, CLASSES = 9, 10
#: The drifting values of a float range are what rows are compared with.
CURVE = np.arange(0.20, 0.85, 0.05).tolist()
GROUPS = [[0, 1, 2], [3, 4], [5, 6, 7, 8]]


def logits(first: int):
    return F.transform(F.slice("embedding", first, CLASSES), lambda x: x.cast("double") * 10.0)


def preds(spark, sf_dir):
    return ev.predictions(table(spark, sf_dir, "embeddings"), "vec_id", "label", logits(1))


def _view(first: int) -> str:
    return f"""SELECT vec_id, y, CAST(i AS INT) AS i, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM (
  SELECT vec_id, y, i, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM (
    SELECT vec_id, label AS y, UNNEST(range({CLASSES})) AS i, UNNEST(list_transform(embedding[{first}:{first + CLASSES - 1}], lambda x: CAST(x AS DOUBLE) * 10.0)) AS z FROM embeddings))"""


#: preds: a row for each class, ranked; one: a row for each vector; others: ranks without class 9.
PREDS_SQL = f"""
WITH preds AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS rn FROM ({_view(1)})),
others AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS rk FROM preds WHERE i <> {OTHER}),
one AS (SELECT vec_id, y, max(CASE WHEN rn = 1 THEN i END) AS pred, max(p) AS conf, max(CASE WHEN i = {OTHER} THEN p END) AS op,
  CAST(max(CASE WHEN rn <= 1 AND i = y THEN 1 ELSE 0 END) AS DOUBLE) AS h1, CAST(max(CASE WHEN rn <= 3 AND i = y THEN 1 ELSE 0 END) AS DOUBLE) AS h3 FROM preds GROUP BY vec_id, y),
fish AS (SELECT vec_id, CAST(max(CASE WHEN rk <= 1 AND i = y THEN 1 ELSE 0 END) AS DOUBLE) AS f1, CAST(max(CASE WHEN rk <= 3 AND i = y THEN 1 ELSE 0 END) AS DOUBLE) AS f3 FROM others GROUP BY vec_id),
classes AS (SELECT CAST(range AS INT) AS class FROM range({CLASSES})),
cells AS (SELECT a.class AS y, b.class AS pred, count(o.vec_id) AS n FROM classes a CROSS JOIN classes b LEFT JOIN one o ON o.y = a.class AND o.pred = b.class GROUP BY 1, 2),
shares AS (SELECT *, coalesce(n / nullif(sum(n) OVER (PARTITION BY y), 0), 0.0) AS share FROM cells),
per AS (SELECT class, CAST(s AS BIGINT) AS support, coalesce(tp / nullif(pn, 0), 0.0) AS precision, coalesce(tp / nullif(s, 0), 0.0) AS recall, coalesce(t3 / nullif(s, 0), 0.0) AS top3_recall FROM (
  SELECT class, (SELECT count(*) FROM one WHERE y = class) AS s, (SELECT count(*) FROM one WHERE pred = class) AS pn, (SELECT count(*) FROM one WHERE pred = class AND y = class) AS tp,
    (SELECT count(*) FROM one WHERE h3 = 1 AND y = class) AS t3 FROM classes))
"""
_T = f"(SELECT UNNEST([{', '.join(map(repr, CURVE))}]) AS t)"
_KEPT = "CASE WHEN count(*) FILTER (conf >= t) = 0 THEN CAST('nan' AS DOUBLE) ELSE avg({}) FILTER (conf >= t) END"
_UNSURE = f"(conf < t OR pred = {OTHER})"
SWEEP_SQL = PREDS_SQL + f""", sweep AS (SELECT t, avg(CASE WHEN {_UNSURE} THEN 1.0 ELSE 0.0 END) FILTER (y <> {OTHER}) AS fish_reject_rate,
  coalesce(avg(f3) FILTER (y <> {OTHER} AND NOT {_UNSURE}), 0.0) AS top3_on_kept, coalesce(avg(f1) FILTER (y <> {OTHER} AND NOT {_UNSURE}), 0.0) AS top1_on_kept,
  avg(CASE WHEN {_UNSURE} THEN 1.0 ELSE 0.0 END) FILTER (y = {OTHER}) AS other_caught, count(*) FILTER (y <> {OTHER} AND NOT {_UNSURE}) AS kept_n
  FROM one JOIN fish USING (vec_id) CROSS JOIN {_T} GROUP BY t)"""


@query("topk_accuracy", PREDS_SQL + "SELECT count(*) AS n, avg(h1) AS top1, avg(h3) AS top3 FROM one")
def topk_accuracy(spark, sf_dir):
    return ev.topk_accuracy(preds(spark, sf_dir))


@query("per_class_prf", PREDS_SQL + "SELECT class, support, precision, recall, top3_recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM per")
def per_class_prf(spark, sf_dir):
    return ev.per_class(preds(spark, sf_dir), ev.class_dim(spark, CLASSES))


@query("confusion_dense", PREDS_SQL + "SELECT y, pred, n FROM cells")
def confusion_dense(spark, sf_dir):
    return ev.confusion(preds(spark, sf_dir), ev.class_dim(spark, CLASSES))


@query("confusion_row_norm", PREDS_SQL + "SELECT y, pred, n, share FROM shares")
def confusion_row_norm(spark, sf_dir):
    return ev.confusion_shares(preds(spark, sf_dir), ev.class_dim(spark, CLASSES))


_MEMBERS = ", ".join(f"({a}, {k})" for k, g in enumerate(GROUPS) for a in g)
_PAIRS = ", ".join(f"({a}, {b})" for g in GROUPS for i, a in enumerate(g) for b in g[i + 1 :])


@query("confusable_pairs", PREDS_SQL + f""", pr AS (SELECT a, b, s.share * 100 AS ab, r.share * 100 AS ba FROM (VALUES {_PAIRS}) v(a, b)
  JOIN shares s ON s.y = a AND s.pred = b JOIN shares r ON r.y = b AND r.pred = a),
gr AS (SELECT * FROM (VALUES {_MEMBERS}) v(class, g)),
outs AS (SELECT y, sum(CASE WHEN t.g = o.g THEN 0.0 ELSE share END) * 100 AS outside FROM shares JOIN gr o ON o.class = y LEFT JOIN gr t ON t.class = pred GROUP BY y),
k AS (SELECT *, least(ab, ba) > 0 AND greatest(ab, ba) / nullif(least(ab, ba), 0) < 2 AS even FROM pr WHERE greatest(ab, ba) >= 5)
SELECT a, b, ab, ba, (SELECT outside FROM outs WHERE y = a) AS a_out, (SELECT outside FROM outs WHERE y = b) AS b_out, CASE WHEN even THEN 'symmetric' ELSE 'asymmetric' END AS kind, CASE WHEN NOT even THEN CASE WHEN ab > ba THEN a ELSE b END END AS source FROM k""")
def confusable_pairs(spark, sf_dir):
    return ev.confusable_pairs(preds(spark, sf_dir), ev.class_dim(spark, CLASSES), GROUPS)


@query("macro_and_ood", PREDS_SQL + f"""SELECT round((SELECT avg(recall) FROM per), 9) AS macro_recall,
  (SELECT coalesce(avg(CASE WHEN pred = {OTHER} THEN 1.0 ELSE 0.0 END), 0.0) FROM one WHERE y <> {OTHER}) AS other_fp""")
def macro_and_ood(spark, sf_dir):
    return ev.macro_and_ood(preds(spark, sf_dir), ev.class_dim(spark, CLASSES), OTHER).withColumn("macro_recall", rounded(F.col("macro_recall"), 9))


@query("threshold_curve", PREDS_SQL + f"SELECT t, avg(CASE WHEN conf >= t THEN 0.0 ELSE 1.0 END) AS reject_rate, {_KEPT.format('h1')} AS top1, {_KEPT.format('h3')} AS top3 FROM one CROSS JOIN {_T} GROUP BY t")
def threshold_curve(spark, sf_dir):
    return ev.threshold_curve(preds(spark, sf_dir), CURVE)


@query("serving_sweep", SWEEP_SQL + "SELECT * FROM sweep")
def serving_sweep(spark, sf_dir):
    return ev.serving_sweep(preds(spark, sf_dir), CURVE, OTHER)


@query("choose_threshold", SWEEP_SQL + """SELECT * FROM sweep ORDER BY fish_reject_rate <= 0.10 DESC,
  CASE WHEN fish_reject_rate <= 0.10 THEN top3_on_kept END DESC NULLS LAST, fish_reject_rate, t LIMIT 1""")
def choose_threshold(spark, sf_dir):
    return ev.choose_threshold(ev.serving_sweep(preds(spark, sf_dir), CURVE, OTHER))


@query("worst_cases", PREDS_SQL + "SELECT vec_id AS id, y, pred, round(conf, 6) AS conf FROM one WHERE pred <> y ORDER BY one.conf DESC, vec_id LIMIT 50")
def worst_cases(spark, sf_dir):
    return ev.worst_cases(preds(spark, sf_dir)).withColumn("conf", rounded(F.col("conf"), 6))


@query("bottom_classes", PREDS_SQL + "SELECT class, recall, support, recall < 0.60 AS below FROM per ORDER BY recall, class LIMIT 8")
def bottom_classes(spark, sf_dir):
    return ev.bottom_classes(preds(spark, sf_dir), ev.class_dim(spark, CLASSES))


@query("accuracy_by_label", PREDS_SQL + "SELECT y, count(*) AS n, avg(h1) AS top1, avg(h3) AS top3 FROM one GROUP BY y")
def accuracy_by_label(spark, sf_dir):
    return ev.source_metrics(preds(spark, sf_dir), "y")


@query("group_sum_probs", PREDS_SQL + "SELECT vec_id AS id, " + ", ".join(f"round(sum(CASE WHEN i IN ({', '.join(map(str, g))}) THEN p ELSE 0.0 END), 6) AS g{k}" for k, g in enumerate(GROUPS)) + " FROM preds GROUP BY vec_id")
def group_sum_probs(spark, sf_dir):
    return preds(spark, sf_dir).select("id", *(rounded(group_sum(F.col("p"), g), 6).alias(f"g{k}") for k, g in enumerate(GROUPS)))


@query("tta_mean", f"WITH a AS ({_view(1)}), b AS ({_view(11)}) SELECT vec_id AS id, a.i AS class, round((a.p + b.p) / 2, 6) AS p FROM a JOIN b USING (vec_id, i)")
def tta_mean(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    both = df.select(F.col("vec_id").alias("id"), F.zip_with(ev.softmax(logits(1)), ev.softmax(logits(11)), lambda a, b: (a + b) / 2).alias("p"))
    return both.select("id", F.posexplode("p").alias("class", "p")).withColumn("p", rounded(F.col("p"), 6))


@query("format_result_rows", PREDS_SQL + f"""SELECT vec_id AS id, CAST(rk AS INT) AS rank, i AS class, round(p, 6) AS confidence, conf < 0.25 OR pred = {OTHER} AS uncertain,
  round(conf, 6) AS top1_confidence, round(op, 6) AS other_confidence FROM others JOIN one USING (vec_id) WHERE rk <= 3""")
def format_result_rows(spark, sf_dir):
    rows = ev.served_rows(preds(spark, sf_dir), 0.25, OTHER)
    return rows.withColumns({c: rounded(F.col(c), 6) for c in ("confidence", "top1_confidence", "other_confidence")})


@query("field_test_summary", PREDS_SQL + f"""SELECT count(*) AS n, avg(u) AS uncertain_rate, avg(CASE WHEN y = {OTHER} THEN u ELSE f1 END) AS top1, avg(CASE WHEN y = {OTHER} THEN u ELSE f3 END) AS top3
  FROM (SELECT *, CASE WHEN conf < 0.25 OR pred = {OTHER} THEN 1.0 ELSE 0.0 END AS u FROM one JOIN fish USING (vec_id))""")
def field_test_summary(spark, sf_dir):
    return ev.field_summary(preds(spark, sf_dir), 0.25, OTHER)


@query("temperature_accuracy", f"""WITH z AS (SELECT vec_id, label AS y, UNNEST(range({CLASSES})) AS i, UNNEST(list_transform(embedding[1:{CLASSES}], lambda x: CAST(x AS DOUBLE) * 10.0)) AS z FROM embeddings),
e AS (SELECT vec_id, t, exp((z - max(z) OVER (PARTITION BY vec_id, t)) / t) AS e FROM z CROSS JOIN (VALUES (0.5), (1.0), (2.0)) v(t)),
m AS (SELECT vec_id, CAST(t AS DOUBLE) AS t, max(e) / sum(e) AS conf FROM e GROUP BY vec_id, t) SELECT t, round(avg(conf), 6) AS mean_conf FROM m GROUP BY t""")
def temperature_accuracy(spark, sf_dir):
    """Mean confidence after division of the logits by a temperature."""
    df = table(spark, sf_dir, "embeddings")
    cooled = lambda t: F.array_max(ev.softmax(F.transform(logits(1), lambda x: x / F.lit(t))))
    conf = [F.struct(F.lit(t).alias("t"), cooled(t).alias("conf")) for t in (0.5, 1.0, 2.0)]
    return df.select(F.inline(F.array(*conf))).groupBy("t").agg(rounded(F.avg("conf"), 6).alias("mean_conf"))
