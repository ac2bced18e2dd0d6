"""Queries on configurations: rules in one pass, label and metrics documents, kept predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleanworks.functions.arrays import rounded
from gleanworks.operators import cache as ca
from gleanworks.operators import constraints as co
from gleanworks.operators import documents as do
from gleanworks.operators import evaluation as ev
from gleanworks.operators import learning as le
from gleanworks.plans.catalog import query
from gleanworks.plans.evaluation import CLASSES, CURVE, PREDS_SQL, preds
from gleanworks.plans.learning import WEIGHTS
from gleanworks.session import checkpoint_root, table

#: Parts as a list of species, with faults: a repeated name, repeated and blank scientific names, odd kinds and places, unknown neighbours.
_SPECIES = """WITH s AS (SELECT p_partkey AS idx, CASE WHEN p_partkey % 40 = 7 THEN 'twice' ELSE p_name || p_partkey END AS name,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE p_type || p_partkey // 2 END AS scientific, CASE WHEN p_size = 50 THEN 'odd' ELSE ['easy', 'medium', 'hard'][p_size % 3 + 1] END AS difficulty,
  CASE WHEN p_size = 49 THEN NULL ELSE ['sea', 'fresh', 'other', 'air'][p_partkey % 11 // 3 + 1] END AS habitat, p_name || (p_partkey + 1) AS near FROM part)
"""


def species(spark, sf_dir):
    i, pick = F.col("p_partkey"), lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        i.alias("idx"), F.when(i % 40 == 7, "twice").otherwise(F.concat("p_name", i.cast("string"))).alias("name"),
        F.when(i % 5 == 0, "").when(i % 5 > 1, F.concat("p_type", F.floor(i / 2).cast("string"))).alias("scientific"),
        F.when(F.col("p_size") == 50, "odd").otherwise(pick(("easy", "medium", "hard"), F.col("p_size") % 3)).alias("difficulty"),
        F.when(F.col("p_size") != 49, pick(("sea", "fresh", "other", "air"), F.floor(i % 11 / 3))).alias("habitat"),
        F.array(F.concat("p_name", (i + 1).cast("string")), F.concat("p_name", i.cast("string"))).alias("confusable"),
    )


RULES = [
    co.Count("classes", 25), co.Count("fish", 24, "habitat <> 'other'"), co.Unique("name", "name"), co.Unique("scientific", "scientific"),
    co.Among("difficulty", "difficulty", ("easy", "medium", "hard")), co.Among("habitat", "habitat", ("sea", "fresh", "other")), co.Known("confusable", "confusable", "name"), co.Last("other_last", "idx", "habitat", "other"),
]


@query("config_violations", _SPECIES + """, c AS (SELECT 'confusable' AS rule, w AS who FROM s, (VALUES (0), (1)) v(k), LATERAL (SELECT CASE k WHEN 0 THEN near ELSE p_name || idx END AS w FROM part WHERE p_partkey = idx))
SELECT 'classes' AS rule, count(*)::VARCHAR AS who, count(*) AS n FROM s HAVING count(*) <> 25
UNION ALL SELECT 'fish', count(*)::VARCHAR, count(*) FROM s WHERE habitat <> 'other' HAVING count(*) <> 24
UNION ALL SELECT 'name', name, count(*) FROM s GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'scientific', scientific, count(*) FROM s WHERE trim(scientific) <> '' GROUP BY scientific HAVING count(*) > 1
UNION ALL SELECT 'difficulty', difficulty, count(*) FROM s WHERE difficulty NOT IN ('easy', 'medium', 'hard') GROUP BY difficulty
UNION ALL SELECT 'habitat', habitat, count(*) FROM s WHERE coalesce(habitat NOT IN ('sea', 'fresh', 'other'), true) GROUP BY habitat
UNION ALL SELECT rule, who, count(*) FROM c WHERE who NOT IN (SELECT name FROM s) GROUP BY rule, who
UNION ALL SELECT 'other_last', arg_max_null(habitat, idx), 1 FROM s HAVING coalesce(arg_max_null(habitat, idx) <> 'other', true)""")
def config_violations(spark, sf_dir):
    """Every rule over the stand-in species, in one pass."""
    return co.violations(species(spark, sf_dir), RULES)[0]


def _nations(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("idx"), F.col("n_name").alias("name"), F.initcap("n_name").alias("scientific"), F.lower("r_name").alias("habitat"), F.element_at(F.array(*map(F.lit, ("easy", "medium", "hard"))), (F.col("n_nationkey") % 3 + 1).cast("int")).alias("difficulty"),
    )


def _labels(spark, sf_dir):
    return do.stamped(do.label_document(_nations(spark, sf_dir), "UNITED STATES", 0.25, 3), 384, [0.5, 0.25, 0.125], [0.5, 0.5, 0.25], "b0", "v1")


@query("label_document", """SELECT CAST(n_nationkey AS INT) AS idx, n_name AS name, upper(n_name[1]) || lower(n_name[2:]) AS scientific0, lower(r_name) AS habitat, ['easy', 'medium', 'hard'][n_nationkey % 3 + 1] AS difficulty,
  (SELECT count(*) FROM nation)::INT AS num_classes, (SELECT n_nationkey FROM nation WHERE n_name = 'UNITED STATES')::INT AS other_index, 0.25::DOUBLE AS threshold, 3 AS top_k, 437 AS shorter, 0.125::DOUBLE AS blue, 'v1' AS version
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def label_document(spark, sf_dir):
    """The label dictionary written, read again and asked by path."""
    path = f"{checkpoint_root(spark)}/labels-{uuid.uuid4().hex}"
    do.save_documents(_labels(spark, sf_dir), path)
    doc = do.load_documents(spark, path)
    told = doc.select(
        do.at("$.num_classes", "int").alias("num_classes"), do.at("$.other_index", "int").alias("other_index"), do.at("$.confidence_threshold", "double").alias("threshold"), do.at("$.top_k", "int").alias("top_k"),
        do.at("$.preprocess.resize_shorter_to", "int").alias("shorter"), do.at("$.preprocess.mean[2]", "double").alias("blue"), do.at("$.model.version", "string").alias("version"),
    )
    rows = do.species_rows(doc)
    first = F.concat(F.upper(F.substring("scientific", 1, 1)), F.lower(F.substring("scientific", 2, 1000)))
    return rows.select("idx", "name", first.alias("scientific0"), "habitat", "difficulty").crossJoin(told)  # one row


@query("health_rows", """SELECT 'health' AS answer, 200 AS code, '{"status":"ok","model_version":"v1","num_classes":' || count(*) || ',"img_size":384,"tta":false,"confidence_threshold":0.35}' AS body FROM nation
UNION ALL SELECT 'labels', 200, to_json(list(n_name ORDER BY n_nationkey)) FROM nation UNION ALL SELECT 'health of none', 503, '{"status":"unavailable","error":"MODEL_NOT_LOADED"}'""")
def health_rows(spark, sf_dir):
    """What serving answers about itself, with a threshold chosen later, and without a model."""
    doc = do.with_threshold(_labels(spark, sf_dir), 0.35)
    labels = do.labels(doc).withColumn("body", F.to_json(F.from_json("body", "classes array<string>")["classes"]))
    named = lambda df, name: df.select(F.lit(name).alias("answer"), "code", "body")
    return named(do.health(doc), "health").unionByName(named(labels, "labels")).unionByName(named(do.health(doc.limit(0)), "health of none"))


_T = f"(SELECT UNNEST([{', '.join(map(repr, CURVE))}]) AS t)"


@query("metrics_fields", PREDS_SQL + f""", c AS (SELECT t, avg(CASE WHEN conf >= t THEN 0.0 ELSE 1.0 END) AS reject_rate, avg(h1) FILTER (conf >= t) AS top1, avg(h3) FILTER (conf >= t) AS top3 FROM one CROSS JOIN {_T} GROUP BY t),
w AS (SELECT row_number() OVER (ORDER BY conf DESC, vec_id) - 1 AS k, * FROM one WHERE pred <> y),
f AS (SELECT 'overall' AS part, '' AS key, UNNEST(['n', 'top1', 'top3']) AS field, UNNEST([count(*)::DOUBLE, avg(h1), avg(h3)]) AS value FROM one
UNION ALL SELECT 'per_class', class::VARCHAR, UNNEST(['support', 'precision', 'recall', 'top3_recall', 'f1']), UNNEST([support::DOUBLE, precision, recall, top3_recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0)]) FROM per
UNION ALL SELECT 'threshold_curve', (row_number() OVER (ORDER BY t) - 1)::VARCHAR, UNNEST(['t', 'reject_rate', 'top1', 'top3']), UNNEST([t, reject_rate, top1, top3]) FROM c
UNION ALL SELECT 'worst_cases', k::VARCHAR, UNNEST(['id', 'y', 'pred', 'conf']), UNNEST([vec_id::DOUBLE, y::DOUBLE, pred::DOUBLE, conf]) FROM w WHERE k < 50)
SELECT part, key, field, round(value, 6) AS value FROM f""")
def metrics_fields(spark, sf_dir):
    """All fields of the metrics document, written as a VARIANT and read back by path."""
    path = f"{checkpoint_root(spark)}/metrics-{uuid.uuid4().hex}"
    do.save_documents(ev.metrics_document(preds(spark, sf_dir), ev.class_dim(spark, CLASSES), CURVE).select(do.as_variant(F.col("document")).alias("document")), path)
    doc = do.load_documents(spark, path)
    # A share over no rows is written as the string NaN.
    number = F.nanvl(F.col("value"), F.lit(None).cast("double"))
    told = lambda part, key, fields: F.transform(F.map_entries(fields), lambda e: F.struct(F.lit(part).alias("part"), key.cast("string").alias("key"), e["key"].alias("field"), e["value"].alias("value")))
    one = "map<string,double>"
    parts = [doc.select(F.inline(told("overall", F.lit(""), do.at("$.overall", one))))]
    per = doc.select(F.explode(do.at("$.per_class", f"map<string,{one}>")).alias("k", "m"))
    parts.append(per.select(F.inline(told("per_class", F.col("k"), F.col("m")))))
    for part in ("threshold_curve", "worst_cases"):
        rows = doc.select(F.posexplode(do.at(f"$.{part}", f"array<{one}>")).alias("k", "m"))
        parts.append(rows.select(F.inline(told(part, F.col("k"), F.col("m")))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("part", "key", "field", rounded(number, 6).alias("value"))


@query("prediction_cache", """WITH v AS (SELECT array_to_string(embedding, ',') AS c, vec_id FROM embeddings), n AS (SELECT count(DISTINCT c) AS n FROM v),
m AS (SELECT count(DISTINCT CASE WHEN vec_id % 10 = 0 THEN c END) AS n FROM v), s AS (SELECT count(*) AS rows FROM v)
SELECT 'first' AS run, rows, n.n AS scored FROM s, n UNION ALL SELECT 'again', rows, 0 FROM s UNION ALL SELECT 'changed', rows, m.n FROM s, m UNION ALL SELECT 'other model', rows, n.n FROM s, n""")
def prediction_cache(spark, sf_dir):
    """Inputs scored by each of four runs over one store: all, none, those that changed, all by another model."""
    path = f"{checkpoint_root(spark)}/predictions-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.to_json(F.struct(F.col("embedding").alias("v"))).alias("content"))
    changed = rows.withColumn("content", F.when(F.col("vec_id") % 10 == 0, F.concat("content", F.lit(" "))).otherwise(F.col("content")))
    score = lambda df: le.batch_scores(df.withColumn("e", F.from_json("content", "v array<float>")["v"]), "e", WEIGHTS, "p")
    out = None
    for run, df, model in (("first", rows, "m1"), ("again", rows, "m1"), ("changed", changed, "m1"), ("other model", rows, "m2")):
        found, scored = ca.cached_scores(df, "content", model, "none", score, path)
        one = found.agg(F.lit(run).alias("run"), F.count("p").alias("rows"), F.lit(scored).cast("long").alias("scored"))
        out = one if out is None else out.unionByName(one)
    return out
